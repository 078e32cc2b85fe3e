"""Language-model scores by stupid backoff, computed as joins of n-gram tables.

Counts come from the whole corpus. A word is scored by its n-gram with the words before it where the corpus
has that n-gram at least ``cutoff`` times, else by the next shorter one times ``backoff``, down to its own
frequency; words at a text's start have shorter n-grams only, without a factor. A document's score is the
mean of the logarithms. With cutoff 1 every n-gram counts, and a word backs off only where the count is 0.

Documents are dealt to slices. A slice names each of its distinct n-grams once, as a number with its count,
to the part of the count table that holds this number; n-gram counts are partitioned by ranges of a hash. There
counts of all slices are summed up and each slice gets its answers, joined back to its exploded n-grams and
summed per document. So the n-gram of a third of all words is one number of each slice, and what is shuffled
is a text, once, and 5 bytes for each distinct n-gram of a slice and about one for its answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_of
from feedloom.session import staged

BACKOFF = 0.4
CUTOFF = 1
ORDER = 3
#: Bytes of text in a slice, on average. Larger slices repeat fewer n-grams and take more memory (30 times as much).
SLICE = 12_000_000
KEPT = 200_000
#: N-grams are numbers of so many bits: among 10^9 of them about four pairs share one.
BITS = 56
ESCAPE = 255


class _Codes(dict):
    """Word -> 64-bit number, for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KEPT:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_CODES = _Codes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Words:
    """The words of some texts in one row, with the n-grams that end at each word.

    Words lie between ASCII white space, A-Z in lower case. ``grams[k - 1]`` are the numbers of the n-grams of
    k words that end at the places ``at[k - 1]``.
    """

    def __init__(self, texts: Sequence[str], order: int) -> None:
        codes = [self._codes(t) for t in texts]
        self.sizes = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes))
        code = np.concatenate([*codes, np.zeros(0, dtype=np.uint64)])
        total = len(code)
        del codes
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        place = np.arange(total) - first[self.doc]
        self.at, self.grams, whole = [], [], code
        for k in range(1, order + 1):
            if k > 1:
                whole = np.concatenate([whole[:1], whole[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + code[1:]])
            whole = _mixed(whole + np.uint64(k))
            at = np.flatnonzero(place >= k - 1).astype(np.int32)
            self.at.append(at)
            self.grams.append(whole[at] >> np.uint64(64 - BITS))

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(_CODES.__getitem__, words), dtype=np.uint64, count=len(words))


def _pack(sorted_grams: np.ndarray) -> bytes:
    """Ascending numbers as the first and the steps between them, in as many bytes each as the largest step needs."""
    steps = np.diff(sorted_grams).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + sorted_grams[:1].astype("<u8").tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    width, first = data[0], np.frombuffer(data[1:9], dtype="<u8")
    rest = np.frombuffer(data, dtype=np.uint8, offset=1 + 8 * len(first)).reshape(-1, width)
    steps = np.zeros((len(rest), 8), dtype=np.uint8)
    steps[:, :width] = rest
    return np.cumsum(np.concatenate([first, steps.view("<u8").ravel()]), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte for each count; those of 255 or more follow in 8 bytes."""
    high = counts[counts >= ESCAPE].astype("<i8")
    return np.minimum(counts, ESCAPE).astype(np.uint8).tobytes() + high.tobytes()


def _unpack_counts(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, dtype=np.uint8, count=n).astype(np.int64)
    counts[counts == ESCAPE] = np.frombuffer(data, dtype="<i8", offset=n)
    return counts


_ASKED = "slice int, words int, part int, n int, grams binary, counts binary"
_ANSWERED = "slice int, words int, part int, n int, counts binary"


def _ask(docs: pa.Table, order: int, parts: int) -> pa.Table:
    """The distinct n-grams of a slice with their counts, one row for each length and part of the count table."""
    number, rows = docs["slice"][0].as_py(), []
    for k, found in enumerate(_Words(docs["text"].to_pylist(), order).grams, 1):
        grams, counts = np.unique(found, return_counts=True)
        part = ((grams >> np.uint64(BITS - 32)) * np.uint64(parts)) >> np.uint64(32)
        edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        rows += [
            (number, k, p, int(b - a), _pack(grams[a:b]), _pack_counts(counts[a:b]))
            for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
            if b > a
        ]
    return _table(rows, _ASKED)


def _answer(asked: pa.Table) -> pa.Table:
    """One part of a count table: counts over all slices, given back to each in its own order."""
    asked = asked.to_pylist()
    grams = np.concatenate([_unpack(r["grams"]) for r in asked])
    held, own = np.unique(grams, return_inverse=True)
    total, at = np.zeros(len(held), dtype=np.int64), 0
    for r in asked:  # a slice names an n-gram once
        total[own[at : at + r["n"]]] += _unpack_counts(r["counts"], r["n"])
        at += r["n"]
    found = np.split(total[own], np.cumsum([r["n"] for r in asked])[:-1])
    rows = [(r["slice"], r["words"], r["part"], r["n"], _pack_counts(c)) for r, c in zip(asked, found, strict=True)]
    return _table(rows, _ANSWERED)


def _score(docs: pa.Table, answers: pa.Table, order: int, cutoff: int, backoff: float) -> pa.Table:
    """(id, n_words, log_sum, n_alone) of a slice's documents; n_alone words stand on their own frequency, whose
    logarithm still lacks the number of all words."""
    words = _Words(docs["text"].to_pylist(), order)
    total = len(words.doc)
    count = np.zeros((order, total))
    found: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in range(order)]
    for r in sorted(answers.to_pylist(), key=lambda r: r["part"]):
        found[r["words"] - 1].append(_unpack_counts(r["counts"], r["n"]))
    for k in range(order):
        own = np.unique(words.grams[k], return_inverse=True)[1]
        count[k, words.at[k]] = np.concatenate(found[k])[own]
        words.grams[k] = found[k] = None
    log, fell, done = np.zeros(total), np.zeros(total), np.zeros(total, dtype=bool)
    for k in range(order, 1, -1):
        here = np.zeros(total, dtype=bool)
        here[words.at[k - 1]] = True
        here &= ~done
        hit = np.flatnonzero(here & (count[k - 1] >= cutoff))
        log[hit] = np.log(count[k - 1, hit] / count[k - 2, hit - 1])
        done[hit] = True
        fell += here & ~done
    alone = np.flatnonzero(~done)
    log[alone] = np.log(count[0, alone])
    n = len(words.sizes)
    sums = np.bincount(words.doc, weights=log + fell * math.log(backoff), minlength=n).astype(np.float64)
    return pa.table(
        {
            "id": docs["id"],
            "n_words": words.sizes,
            "log_sum": sums,
            "n_alone": np.bincount(words.doc[alone], minlength=n).astype(np.int64),
        }
    )


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [tuple(f.split()) for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({name: pa.array(c, type=kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


def scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    backoff: float = BACKOFF,
    cutoff: int = CUTOFF,
    order: int = ORDER,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """(id, n_words, log_score) per row: the mean log score of its words; null for a text without words.

    Null ids and texts (empty) are kept; repeated rows count in the corpus each time and get the
    same score; an empty table gives an empty one. Texts are read whole; a slice with a very long text is as
    large as that text.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(held / slice_bytes))
    number = F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(parts)).cast("int")
    dealt = rows.withColumn("slice", number)

    def ask(table: pa.Table) -> pa.Table:
        return _ask(table, order, parts)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(left, right, order, cutoff, backoff)

    asked = dealt.groupBy("slice").applyInArrow(ask, _ASKED)
    answered = asked.groupBy("words", "part").applyInArrow(_answer, _ANSWERED)
    kind = rows.schema["id"].dataType.simpleString()
    scored = dealt.groupBy("slice").cogroup(answered.groupBy("slice")).applyInArrow(
        score, f"id {kind}, n_words long, log_sum double, n_alone long"
    )
    scored = staged(scored, "backoff-sums")
    total = scored.agg(F.sum("n_words")).first()[0] or 1
    mean = (F.col("log_sum") - F.col("n_alone") * F.lit(math.log(total))) / F.col("n_words")
    return scored.select("id", "n_words", F.when(F.col("n_words") > 0, mean).alias("log_score"))
