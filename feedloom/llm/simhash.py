"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits; a bit is set if more than half of the text's word shingles have it set
in their hash. Two fingerprints link when they differ in few bits. They are cut into segments, so
many that one segment of a linked pair differs in one bit at most (pigeonhole); each fingerprint
looks up its segments and their Hamming balls of radius one in a table of all segments, and the
whole distance of what is found is checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, text_key, text_of
from feedloom.llm.components import connected
from feedloom.session import staged

SEED = 42
#: Beyond so many fingerprints with one segment value, a second level of segments is used.
BUSY = 1024
BLOCK = 255  # one byte counts so many


def simhash(text: str, words: int) -> int:
    """Fingerprint as a signed 64-bit number; 0 for a text without words."""
    import xxhash

    # Bytes split and lower-case exactly the ASCII white space and letters.
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), BLOCK * 64):
        bits = np.unpackbits(hashes[start : start + BLOCK * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for at in range(0, len(bits), BLOCK):
            total += bits[at : at + BLOCK].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | Column, words: int = 3) -> Column:
    """SimHash of a text column as bigint: ASCII lower case, words between ASCII white space,
    shingles of ``words`` words with repeats (fewer words: all of them), XXH64 with seed 42.
    A null text is an empty one: fingerprint 0."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, words) for t in texts], dtype="int64")

    return run(text_of(text))


def hex_digits(print_col: str) -> Column:
    return F.lpad(F.lower(F.hex(print_col)), 16, "0")


def _part(value: Column, low: int, high: int) -> Column:
    """Bits low..high-1 of a number."""
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def _cuts(parts: int) -> list[int]:
    return [64 * i // parts for i in range(parts + 1)]


def _entries(prints: DataFrame, parts: int) -> DataFrame:
    """The table side: each fingerprint under each of its segments."""
    cuts = _cuts(parts)
    keys = [F.struct(F.lit(i).alias("seg"), _part(F.col("fp"), cuts[i], cuts[i + 1]).alias("key")) for i in range(parts)]
    return prints.select("fp", F.inline(F.array(*keys)))


def _flips(key: Column, width: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), width - 1), lambda j: key.bitwiseXOR(F.pow(F.lit(2.0), j).cast("long")))


def _width(parts: int, number: str) -> Column:
    cuts = _cuts(parts)
    return F.element_at(F.array(*[F.lit(b - a) for a, b in zip(cuts, cuts[1:], strict=False)]), F.col(number) + 1)


def _probes(entries: DataFrame, parts: int) -> DataFrame:
    """The asking side: each segment value itself, and with each of its zero bits set.

    A pair that differs in one bit of the segment is met from the side that has a zero there, so
    half of the ball is enough.
    """
    key = F.col("key")
    larger = F.filter(_flips(key, _width(parts, "seg")), lambda k: k > key)
    return entries.select("fp", "seg", key.alias("own"), F.explode(F.concat(F.array(key), larger)).alias("key"))


def _met(probes: DataFrame, table: DataFrame, on: list[str], max_bits: int) -> DataFrame:
    """Verified pairs: whole distance within the limit; equal segments count from one side only."""
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    one_side = (F.col("own") != F.col("key")) | (F.col("fp") < F.col("other"))
    return (
        probes.join(table.withColumnRenamed("fp", "other"), on)
        .where((bits <= max_bits) & one_side & (F.col("fp") != F.col("other")))
        .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"), bits.alias("bits"))
    )


def near_pairs(prints: DataFrame, max_bits: int = 3, busy: int = BUSY) -> DataFrame:
    """All pairs (a, b, bits), a < b, of distinct fingerprints ``fp`` that differ in 1..max_bits bits.

    A pair that agrees in several segments comes once for each. Segment values that more than
    ``busy`` fingerprints share are looked up with a second segment (half as long, one bit off at most)
    besides, which leaves no pair out and keeps their candidates apart.
    """
    if max_bits < 1:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b"), F.lit(0).alias("bits")).limit(0)
    parts = max(2, (max_bits + 2) // 2)
    prints = prints.select("fp").where("fp IS NOT NULL").distinct()
    entries = _entries(prints, parts)
    crowded = staged(entries.groupBy("seg", "key").count().where(F.col("count") > busy).select("seg", "key"), "crowded")
    calm = entries.join(crowded, ["seg", "key"], "left_anti")
    probes = _probes(entries, parts)
    pairs = _met(probes, calm, ["seg", "key"], max_bits)
    if crowded.isEmpty():
        return pairs
    fine = 2 * parts
    cuts = _cuts(fine)
    subs = [
        F.when(F.col("seg") != i // 2, F.struct(F.lit(i).alias("sub"), _part(F.col("fp"), cuts[i], cuts[i + 1]).alias("subkey")))
        for i in range(fine)
    ]
    inner = F.inline(F.array_compact(F.array(*subs)))
    full = entries.join(crowded, ["seg", "key"], "left_semi").select("seg", "key", "fp", inner)
    asked = probes.join(crowded, ["seg", "key"], "left_semi").select("seg", "key", "own", "fp", inner)
    # Which side asks is fixed by the first segment, so here the ball is a whole one.
    ball = F.concat(F.array("subkey"), _flips(F.col("subkey"), _width(fine, "sub")))
    asked = asked.withColumn("subkey", F.explode(ball))
    return pairs.union(_met(asked, full, ["seg", "key", "sub", "subkey"], max_bits))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp, t1, t2) per row, written to the shared folder: all that linking needs of a text."""
    t1, t2 = text_key(text_of(text_col))
    return staged(
        docs.select(F.col(id_col).alias("id"), fingerprint(text_col, words).alias("fp"), t1.alias("t1"), t2.alias("t2")),
        "fingerprints",
    )


def link(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, root): every distinct fingerprint with the smallest one that it reaches over links."""
    known = staged(prints.groupBy("fp").agg(F.count("*").alias("rows")).select("fp"), "distinct-fingerprints")
    roots = connected(near_pairs(known, max_bits).select("a", "b"))
    return known.join(roots, known["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3
) -> DataFrame:
    """(id, fp, component_id) per row: the smallest id reachable over links of max_bits or fewer bits.

    Repeated rows stay rows of their own. A null id takes no part in the minimum; where a component has
    no other, component_id is null. An empty table gives an empty one; other columns are not read.
    """
    prints = fingerprints(docs, id_col, text_col, words)
    roots = staged(link(prints, max_bits), "roots")
    low = prints.groupBy("fp").agg(F.min("id").alias("low")).join(roots, "fp")
    heads = low.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = roots.join(heads, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("id", "fp", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3
) -> DataFrame:
    """One document of each component, with all its columns: the one of the smallest id.

    Null ids come last; equal ids are told apart by a hash of the text, equal rows by nothing: one
    of them stays. Documents go once through a shuffle by their key; links and groups are
    worked out on fingerprints alone.
    """
    prints = fingerprints(docs, id_col, text_col, words)
    roots = link(prints, max_bits)
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2")
    first = prints.groupBy("fp").agg(F.min(rank).alias("first")).join(roots, "fp")
    keep = first.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.t1", "first.t2")
    keep = staged(keep, "kept-ids")
    k1 = fresh(docs, "text_key_1")
    k2 = fresh(docs, "text_key_2")
    t1, t2 = text_key(text_of(text_col))
    keyed = docs.withColumns({k1: t1, k2: t2})
    same = keyed[id_col].eqNullSafe(keep["id"]) & (keyed[k1] == keep["t1"]) & (keyed[k2] == keep["t2"])
    return keyed.join(keep, same, "left_semi").dropDuplicates([id_col, k1, k2]).drop(k1, k2)
