"""Token ids as length-delimited binary records with a separate offset index.

A record file is a run of frames:

    length of the payload   8 bytes, little-endian
    masked checksum of the length   4 bytes
    payload
    masked checksum of the payload   4 bytes

A checksum is CRC-32, rotated right by 15 bits plus a constant, as masking keeps checksums of data
that hold checksums apart. A payload is: bytes per id (1 byte: 2 or 4), 1 if the document has an
id (1 byte), the document id (8 bytes, signed), then the token ids. The index file beside it holds
the offset of each frame and at its end the size of the file, 8 bytes each: enough to read any record in any
order. A manifest (Parquet) names the committed files in order, so what a lost task left behind is never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import text_of
from feedloom.llm.tokens import PieceEncoder

MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
LEAD = struct.Struct("<BBq")
SLICE = 4_000_000  # bytes of text encoded, or of ids read, at once
ROW = 16  # bytes that a row counts beside its text

MANIFEST = "part int, file string, records long, ids long, bytes long"
MANIFEST_ARROW = pa.schema(
    [("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked(length)), payload, TAIL.pack(masked(payload))))


def payloads(stream) -> Iterator[bytes]:
    """The payloads of a record file from where the stream stands; a damaged frame raises."""
    while head := stream.read(HEAD.size):
        if len(head) < HEAD.size:
            raise ValueError("a record is cut off")
        length, check = HEAD.unpack(head)
        if masked(head[:8]) != check:
            raise ValueError("the length of a record is damaged")
        body = stream.read(length + TAIL.size)
        if len(body) < length + TAIL.size or masked(body[:length]) != TAIL.unpack(body[length:])[0]:
            raise ValueError("a record is damaged")
        yield body[:length]


def _files(folder: str):
    """The file system behind a folder's address, and the folder in it: local disk or object store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process, so that what it remembers serves later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _slabs(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.Table]:
    """The rows dealt anew, about ``budget`` bytes of text at a time; a longer text is whole and alone."""
    held, size = [], 0
    for batch in batches:
        start = 0
        for at, n in enumerate(pc.binary_length(batch["text"]).to_pylist()):
            if size and size + n > budget:
                held.append(batch.slice(start, at - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, at
            size += n + ROW
        held.append(batch.slice(start))
    if size:
        yield pa.Table.from_batches(held)


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end: list[int]) -> Iterator[pa.RecordBatch]:
    """One task: its rows as one record file and one index; yields their manifest row."""
    part, name = TaskContext.get().partitionId(), f"part-{uuid.uuid4().hex}"
    files = root = out = None
    offsets, total = [0], 0
    pieces = encoder(tokenizer)
    width = 2 if pieces.vocabulary <= 1 << 16 else 4
    last = np.array(end, dtype=f"<u{width}").tobytes()
    try:
        for slab in _slabs(batches, SLICE):
            if out is None:
                files, root = _files(folder)
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(f"{root}/{name}.rec")
            ids, ends = pieces.encode_flat(slab["text"].cast(pa.string()).combine_chunks())
            ids = ids.astype(f"<u{width}")
            for doc, (a, b) in zip(slab["id"].to_pylist(), pairwise(ends.tolist()), strict=True):
                record = frame(LEAD.pack(width, doc is not None, doc or 0) + ids[a:b].tobytes() + last)
                out.write(record)
                offsets.append(offsets[-1] + len(record))
            total += len(ids) + len(end) * len(slab)
            del slab, ids
            pa.default_memory_pool().release_unused()
    finally:
        if out is not None:
            out.close()
    records = len(offsets) - 1
    if records:
        with files.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(np.array(offsets, dtype="<u8").tobytes())
        row = {"part": [part], "file": [name], "records": [records], "ids": [total], "bytes": [offsets[-1]]}
        yield pa.RecordBatch.from_pydict(row, schema=MANIFEST_ARROW)


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 0
) -> DataFrame:
    """Encode every text and write it in ascending id order; returns the manifest.

    ``folder`` is an address that every executor can write to. Each range of ids becomes one file;
    ids of null come first, equal ids are ordered by a hash of the text. A null or empty text has
    the end id alone. Repeated rows are records of their own; an empty table writes no file. A task that runs
    twice writes two files, and the manifest names the one that counted.
    """
    key = F.col(id_col).cast("long")
    # Range partitions in id order; a row is only an id and a text on its way. The hash splits rows of one id.
    ordered = (
        docs.select(key.alias("id"), text_of(text_col).alias("text"))
        .repartitionByRange("id", F.xxhash64("text"))
        .sortWithinPartitions("id", F.xxhash64("text"))
    )
    end = [] if end_id is None else [end_id]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_part(batches, folder, tokenizer, end)

    manifest = ordered.mapInArrow(write, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _read_parts(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for name, start in zip(batch["file"], batch["start"], strict=True):
            files, root = _files(folder)
            with files.open_input_stream(f"{root}/{name}.rec", buffer_size=1 << 20) as stream:
                rows, held, at = [], 0, int(start)
                for number, body in enumerate(payloads(stream)):
                    width, known, doc = LEAD.unpack_from(body)
                    ids = np.frombuffer(body, dtype=f"<u{width}", offset=LEAD.size)
                    rows.append((name, number, doc if known else None, at, ids.astype("<u4").tobytes()))
                    at += len(ids)
                    held += 4 * len(ids)
                    if held > SLICE:
                        yield _frame_of(rows)
                        rows, held = [], 0
                yield _frame_of(rows)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(file, record, id, start, ids) of all committed records, checksums verified.

    ``ids`` are little-endian unsigned 32-bit numbers as binary (see ``id_array``); ``start`` counts the
    ids of all records before this one. The manifest has one row per file; only it is summed up
    in one task.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    spread = placed.repartition(max(1, manifest.count()), "file")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _read_parts(batches, folder)

    return spread.mapInPandas(read, "file string, record long, id long, start long, ids binary")


def _frame_of(rows: list[tuple]) -> pd.DataFrame:
    table = pd.DataFrame(rows, columns=["file", "record", "id", "start", "ids"])
    return table.astype({"id": "Int64"})


def read_at(folder: str, file: str, record: int) -> tuple[int | None, np.ndarray]:
    """One record by its number, through the index: (document id, token ids)."""
    files, root = _files(folder)
    with files.open_input_file(f"{root}/{file}.idx") as index:
        start, stop = np.frombuffer(index.read_at(16, 8 * record), dtype="<u8")
    with files.open_input_file(f"{root}/{file}.rec") as stream:
        stream.seek(int(start))
        body = next(payloads(stream))
    width, known, doc = LEAD.unpack_from(body)
    assert start + len(body) + HEAD.size + TAIL.size == stop
    return (doc if known else None), np.frombuffer(body, dtype=f"<u{width}", offset=LEAD.size)


def digest(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of records as read back."""
    n: Column = (F.octet_length("ids") / 4).cast("long")
    return records.select(F.col("id").alias("doc_id"), "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
