"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Documents are partitioned by the number of their distinct five-word shingles into powers of two. In the
class with at most u shingles, the hash space is cut into ``SLOTS`` * u slots and a document keeps
the smallest hash of each slot. The finer slots of larger classes are what keeps a short item in a
long document findable: of a contained item's shingles each survives with a probability of 0.88
or more in every class. A document is a candidate for an item when its sketch holds a quarter of the item's
hashes, which a contained item of 8 shingles misses with a probability of 0.00002 and longer ones with less;
a phrase that items share with many documents alone makes no candidate. Items of fewer than
``SHORT`` shingles, for which a sketch is too coarse, are met with all hashes in a pass of their own.
Exact shingles of the whole texts of candidates decide.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, text_key, text_of
from feedloom.session import staged

WORDS = 5
SHARE = 0.8
SLOTS = 4
SHORT = 8
KEPT = 200_000


class _Codes(dict):
    """Word -> code, for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        code = self[word] = zlib.crc32(word) << 32 | zlib.adler32(word)
        return code


_CODES = _Codes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles; fewer words make one shingle, no words none."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    code = np.fromiter(map(_CODES.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    if not tokens:
        return code
    span = min(words, len(tokens))
    total = np.full(len(tokens) - span + 1, span, dtype=np.uint64)
    for i in range(span):
        total = _mixed(total + code[i : len(tokens) - span + 1 + i])
    return np.unique(total)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each slot; as many slots as the size class asks for."""
    if len(hashes) < 2:
        return hashes
    slots = np.uint64(SLOTS << int(len(hashes) - 1).bit_length())
    slot = (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % slots
    first = np.unique(slot, return_index=True)[1]  # hashes are sorted: the first is the smallest
    return hashes[first]


def _hashes(text: Column, words: int, whole: bool) -> Column:
    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = (shingle_hashes(t, words) for t in texts)
            yield pd.Series([(h if whole else sketch(h)).view(np.int64) for h in found], dtype=object)

    return run(text)


def shingles(text: Column, words: int = WORDS) -> Column:
    """The distinct shingles themselves: ASCII lower case, words between ASCII white space."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tokens = F.array_remove(F.split(F.translate(text, capitals, capitals.lower()), r"[\x20\x09-\x0D]+"), "")

    def spans(t: Column) -> Column:
        numbers = F.sequence(F.lit(1), F.greatest(F.size(t) - words + 1, F.lit(1)))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).otherwise(
            F.array_distinct(F.transform(numbers, lambda i: F.array_join(F.slice(t, i, words), " ")))
        )

    # As the variable of a lambda the words are worked out once per text and not once per shingle.
    return F.element_at(F.transform(F.array(tokens), spans), 1)


def _candidates(keyed: DataFrame, item_set: DataFrame, words: int) -> DataFrame:
    """(id, t1, t2) of the documents in which an item may be."""
    who = ["id", "t1", "t2"]
    asked = staged(
        item_set.select(
            F.xxhash64("item_id", "item_key").alias("item"),
            F.size("hashes").alias("m"),
            F.explode("hashes").alias("h"),
        ),
        "item-hashes",
    )
    found = keyed.select(*who, F.explode(_hashes(F.col("text"), words, False)).alias("h"))
    met = found.join(asked.where(F.col("m") >= SHORT), "h").groupBy(*who, "item").agg(
        F.count("*").alias("n"), F.first("m").alias("m")
    )
    wanted = met.where(F.col("n") * 4 >= F.col("m")).select(*who)
    few = asked.where(F.col("m") < SHORT)
    if not few.isEmpty():
        every = keyed.select(*who, F.explode(_hashes(F.col("text"), words, True)).alias("h"))
        wanted = wanted.union(every.join(few.select("h").distinct(), "h", "left_semi").select(*who))
    return staged(wanted.distinct(), "candidates")


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    words: int = WORDS,
    share: float = SHARE,
) -> DataFrame:
    """(id, t1, t2, item_id, n_shingles, n_found, containment) of documents that hold an item.

    Containment is the share of the item's distinct shingles that the document has, ``share`` or
    more. Items without words match nothing; items of fewer words than a shingle match a text of
    the same words only. Items that share an id count as items of their own. Repeated documents
    are one match. Null texts are empty; null ids are kept. Item sketches are a written table:
    Spark sends them to all tasks if they are small and else shuffles both sides.

    Shared shingles of candidates and items are counted as rows, with a partial count in each task;
    no task gathers the documents of an item or the items of a document.
    """
    item_rows = items.select(F.col(item_col).alias("item_id"), text_of(item_text_col).alias("text")).distinct()
    item_set = staged(
        item_rows.select(
            "item_id",
            F.xxhash64("text").alias("item_key"),
            shingles(F.col("text"), words).alias("item_shingles"),
            _hashes(F.col("text"), words, True).alias("hashes"),
        ).where(F.size("item_shingles") > 0),
        "items",
    )
    t1, t2 = text_key(text_of(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), t1.alias("t1"), t2.alias("t2"))
    wanted = _candidates(keyed, item_set, words).toDF("_id", "_1", "_2")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_1")) & (F.col("t2") == F.col("_2"))
    held = keyed.join(wanted, same, "left_semi").dropDuplicates(["id", "t1", "t2"])
    own = held.select("id", "t1", "t2", F.explode(shingles(F.col("text"), words)).alias("shingle"))
    asked = item_set.select(
        "item_id", "item_key", F.size("item_shingles").alias("n_shingles"), F.explode("item_shingles").alias("shingle")
    )
    counted = own.join(asked, "shingle").groupBy("id", "t1", "t2", "item_id", "item_key", "n_shingles").agg(
        F.count("*").cast("int").alias("n_found")
    )
    return (
        counted.select("id", "t1", "t2", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))
        .where(F.col("containment") >= share)
        .distinct()
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    held = staged(matches(docs, items, id_col, text_col, **options).select("id", "t1", "t2").distinct(), "contaminated")
    k1, k2 = fresh(docs, "text_key_1"), fresh(docs, "text_key_2")
    t1, t2 = text_key(text_of(text_col))
    keyed = docs.withColumns({k1: t1, k2: t2})
    same = keyed[id_col].eqNullSafe(held["id"]) & (keyed[k1] == held["t1"]) & (keyed[k2] == held["t2"])
    return keyed.join(held, same, "left_anti").drop(k1, k2)
