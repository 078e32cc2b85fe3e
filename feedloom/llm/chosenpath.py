"""Near-duplicates by a chosen-path similarity join over MinHash values.

Documents are sets of word shingles; equal sets are one. Sets that link differ little in size, so
each is dealt to its size class and to the next one. Each tree starts from one MinHash coordinate: sets of a class with
the same value share a node. A node with more than ``SMALL`` sets chooses one or two more coordinates by itself
(1.5 on average) and deals its sets to children by their values, and so on; a pair of similarity s
agrees in a chosen coordinate with probability s, so similar sets stay together on some path while
those below two thirds die out. Small nodes are compared exhaustively. Trees are independent; their number
follows from the recall that is asked for.

A large node branches up to ``LEVELS`` times, unless branching hardly made it smaller than its parent: its sets are
alike, a crowd, which no coordinate would part. Crowds of several trees with the same first set are one. The sets of a
crowd are compared with a few of its own (pivots). Links join classes, and comparisons leave out pairs of
one class. A crowd all of one class is done; in others the sets outside the main class are compared with all others, crowds of one main
class together, tile by tile of their matrix. A tile decides on whole sets and gives only which of its
classes are joined, at most one row for each. So a crowd of near copies costs a few comparisons for each member of its main class, and
one just under the threshold, whose pairs must all be looked at, never makes a row of a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import bounded, text_key, text_of
from feedloom.llm.components import connected
from feedloom.llm.decontamination import shingle_hashes
from feedloom.session import staged

WORDS = 4
PERCENT = 80
COORDINATES = 128
SMALL = 32
PIVOTS = 4
LEVELS = 4
#: A node that keeps so much of its parent is a crowd: its sets are alike.
CROWD = 0.6
#: The least chance that a pair at the threshold survives one tree, all levels: 0.8 at the root, then branches:
#: q <- (x + x * x) / 2 with x = 0.2 + 0.8 * q, four times from 0, gives 0.272 for the loss below it.
SURVIVES = 0.58
RECALL = 0.9999
#: MinHash agreement under which a pair is not looked at: over four standard deviations below the threshold.
AGREE = 0.65
#: Hashes of shingles that a task remembers (8 bytes each).
REMEMBERED = 4_000_000
#: Sets of a side of a tile, the unit in which a crowd is compared, and shingles of them (8 bytes each).
TILE = 512
WEIGHT = 1_000_000
#: Bytes of texts that may be sent to all tasks.
SENT = 16_000_000

_draw = np.random.default_rng(20260101)
_FLIP = _draw.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)
_TIMES = _draw.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each coordinate over a set of 64-bit hashes."""
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    out = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(low), 4096):
        part = low[start : start + 4096, None] ^ _FLIP
        part *= _TIMES
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x85EBCA6B)
        np.minimum(out, part.min(axis=0), out=out)
    return out


def sketches(text: Column, words: int = WORDS) -> Column:
    """(n, k1, k2, mins, bits) of a text: number of distinct shingles, 128 bits for the set, MinHash values and
    the lowest byte of each."""

    @F.pandas_udf("n long, k1 long, k2 long, mins array<int>, bits binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        for texts in batches:
            rows = []
            for text in texts:
                own = shingle_hashes(text, words)
                k = xxhash.xxh3_128_intdigest(own.tobytes())
                k1, k2 = np.array([k >> 64, k & (1 << 64) - 1], dtype=np.uint64).view(np.int64).tolist()
                low = minhash(own) if len(own) else None
                rows.append((len(own), k1, k2, *((low.view(np.int32), low.astype(np.uint8).tobytes()) if len(own) else (None, None))))
            yield pd.DataFrame(rows, columns=["n", "k1", "k2", "mins", "bits"])

    return run(text)


def _agreement(a: Column, b: Column) -> Column:
    """Share of equal coordinates; one byte of each, so unequal ones seem equal once in 256 times."""

    @F.arrow_udf("double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(v.to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES) for v in (x, y))
        return pa.array((left == right).mean(axis=1))

    return run(a, b)


def _linked(a: Column, b: Column, text_a: Column, text_b: Column, words: int, percent: int) -> Column:
    """Whether two whole texts have shingle sets that share enough; sets seen last are remembered by number."""

    @F.pandas_udf("boolean")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known: dict[int, np.ndarray] = {}
        held = 0

        def shingles(number: int, text: str) -> np.ndarray:
            nonlocal held
            if number not in known:
                own = shingle_hashes(text, words)
                if held + len(own) > REMEMBERED:
                    known.clear()
                    held = 0
                known[number] = own
                held += len(own)
            return known[number]

        for batch in batches:
            found = []
            for one, two, x, y in zip(*batch, strict=True):
                x, y = shingles(one, x), shingles(two, y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                found.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pd.Series(found, dtype="bool")

    return run(a, b, text_a, text_b)


def _shingles(text: Column, words: int) -> Column:
    """The whole shingle set of a text as binary, 8 bytes a shingle."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_hashes(text, words).tobytes() for text in texts], dtype=object)

    return run(text)


def _near(tile: pd.DataFrame, roots: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of a tile's outside sets, each with the places of others that its size and agreement allow and whose
    class is another; ``roots`` may change on the way."""
    outside = tile["outside"].to_numpy(dtype=bool)
    sizes = tile["n"].to_numpy(dtype=np.int64)
    mins = np.frombuffer(b"".join(tile["bits"]), dtype=np.uint8).reshape(-1, COORDINATES)
    right = np.flatnonzero(~outside)
    right_mins, right_sizes = mins[right], sizes[right]
    for at in np.flatnonzero(outside):
        fits = 100 * np.minimum(right_sizes, sizes[at]) >= percent * np.maximum(right_sizes, sizes[at])
        fits &= (roots[right] != roots[at]) & ((right_mins == mins[at]).mean(axis=1) >= AGREE)
        yield at, right[fits]


def _near_in_tile(percent: int):
    """The pairs of one tile, outside sets against others, of two classes, that sizes and agreement allow."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        numbers, roots = (tile[c].to_numpy(dtype=np.int64) for c in ("set", "root"))
        a, b = [], []
        for at, near in _near(tile, roots, percent):
            found = numbers[near]
            a.append(np.minimum(found, numbers[at]))
            b.append(np.maximum(found, numbers[at]))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)} if a else {"a": [], "b": []}, dtype="int64")

    return run


def _links_in_tile(percent: int):
    """What the links of one tile join, decided on whole sets: classes (b), each with the smallest one (a) of its component."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        classes, sizes = (tile[c].to_numpy(dtype=np.int64) for c in ("root", "n"))
        roots = classes.copy()  # classes that a link has joined have one root from then on
        ends = np.cumsum(sizes)
        _, codes = np.unique(np.frombuffer(b"".join(tile["shingles"]), dtype=np.uint64), return_inverse=True)
        own = [codes[end - n : end] for end, n in zip(ends, sizes, strict=True)]
        mark = np.zeros(len(codes), dtype=np.uint8)
        for at, near in _near(tile, roots, percent):
            if not len(near):
                continue
            mark[own[at]] = 1
            starts = np.cumsum(sizes[near]) - sizes[near]
            both = np.add.reduceat(mark[np.concatenate([own[x] for x in near])], starts, dtype=np.int64)
            mark[own[at]] = 0
            joined = np.unique(roots[near[100 * both >= percent * (sizes[at] + sizes[near] - both)]])
            roots[np.isin(roots, joined)] = roots[at]
        found = pd.DataFrame({"a": pd.Series(classes).groupby(roots).transform("min"), "b": classes})
        return found[found["a"] != found["b"]].drop_duplicates()

    return run


def _crowd_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Near pairs (a, b) of crowds, rows (crowd, set, root, low): sets outside of the main class ``low`` with all others.
    Where ``sets`` have whole ``shingles``, these decide, and pairs are links (a, b) of classes.

    A crowd is a matrix of tiles of ``TILE`` x ``TILE`` sets or so, fewer where sets are large. A set is copied once for
    each tile of its row or column, so no crowd has to fit into a task and no pair of it is shuffled before it is looked at.
    """
    whole = [c for c in ("shingles",) if c in sets.columns]
    outside = F.col("root") != F.col("low")
    rows = members.join(sets.select("set", "n", "bits", *whole), "set")
    part = lambda x: F.ceil(F.greatest(F.count_if(x) / TILE, F.sum(F.when(x, F.col("n"))) / WEIGHT))
    sizes = members.join(sets.select("set", "n"), "set").groupBy("crowd").agg(part(F.lit(True)).alias("all"), part(outside).alias("out"))
    rows = rows.join(sizes.where("out > 0"), "crowd")
    block = lambda c: F.pmod(F.xxhash64("set"), F.col(c))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    what = ["set", "root", "n", "bits", *whole]
    lines = rows.where(outside).select("crowd", block("out").alias("line"), every("all").alias("col"), F.lit(True).alias("outside"), *what)
    others = rows.select("crowd", every("out").alias("line"), block("all").alias("col"), F.lit(False).alias("outside"), *what)
    tiles = lines.unionByName(others).groupBy("crowd", "line", "col")
    return tiles.applyInPandas((_links_in_tile if whole else _near_in_tile)(percent), "a long, b long").distinct()


class _Sets:
    """The distinct sets of a table, and exact comparison of pairs of them."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> None:
        self.words, self.percent = words, percent
        t1, t2 = text_key(text_of(text_col))
        made = docs.select(
            F.col(id_col).alias("id"), t1.alias("t1"), t2.alias("t2"), sketches(text_of(text_col), words).alias("s")
        )
        self.rows = staged(made.select("id", "t1", "t2", "s.*"), "shingle-sets")
        # One text stands for each set; the sketch goes with it.
        one = self.rows.where("n > 0").groupBy("k1", "k2", "n").agg(
            F.min(F.struct("t1", "t2")).alias("t"), F.first(F.struct("mins", "bits")).alias("m")
        )
        self.sets = staged(one.select(F.monotonically_increasing_id().alias("set"), "k1", "k2", "n", "t.*", "m.*"), "distinct-sets")
        key1, key2 = text_key(F.col("text"))
        whole = docs.select(text_of(text_col).alias("text"))
        self.texts = whole.select(key1.alias("t1"), key2.alias("t2"), "text")

    def texts_of(self, asked: DataFrame) -> DataFrame:
        """(set, text) of the sets that are asked for."""
        keys = staged(self.sets.select("set", "t1", "t2").join(asked, "set"), "asked-sets")
        # Texts are shuffled only where their keys are too many to send to all tasks.
        return self.texts.join(bounded(keys), ["t1", "t2"]).dropDuplicates(["set"]).select("set", "text")

    def whole(self, asked: DataFrame) -> DataFrame:
        """(set, n, bits, shingles) of the sets that are asked for."""
        shingles = self.texts_of(asked).select("set", _shingles(F.col("text"), self.words).alias("shingles"))
        return staged(self.sets.select("set", "n", "bits").join(shingles, "set"), "whole-sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that link: sizes, then MinHash agreement, then the whole sets decide."""
        side = lambda x: self.sets.select(F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"m_{x}"))
        met = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
        met = met.where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
        near = staged(met.where(_agreement(F.col("m_a"), F.col("m_b")) >= AGREE).select("a", "b"), "near-sets")
        asked = near.select(F.explode(F.array("a", "b")).alias("set")).distinct()
        texts = staged(self.texts_of(asked), "asked-texts")
        held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        if held <= SENT:  # few texts of many pairs go to all tasks; else pairs and texts are shuffled
            texts = F.broadcast(texts)
        both = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        linked = _linked(F.col("a"), F.col("b"), F.col("text_a"), F.col("text_b"), self.words, self.percent)
        return staged(both.where(linked).select("a", "b"), "set-links")


def trees_for(recall: float) -> int:
    """Independent trees so that a pair at the threshold is met with this probability."""
    return min(COORDINATES, max(1, math.ceil(math.log(1 - recall) / math.log(1 - SURVIVES))))


def _children(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Each set in one or two children of its node, by the values of coordinates that the node chooses."""
    chosen = [F.pmod(F.xxhash64("node", F.lit(j)), F.lit(COORDINATES)).cast("int") for j in range(2)]
    one, two = (F.xxhash64("node", F.lit(j), c, F.get("mins", c)) for j, c in enumerate(chosen))
    keys = F.when(F.xxhash64("node", F.lit("two")) % 2 == 0, F.array(one)).otherwise(F.array(one, two))
    return rows.join(sets.select("set", "mins"), "set").select("set", F.col("size").alias("above"), F.explode(keys).alias("node"))


def _roots(sets: DataFrame, trees: int, percent: int) -> DataFrame:
    # Sizes of linked sets lie within 100 / percent of each other: at most one class apart.
    size_class = F.floor(F.ln("n") / (math.log(100 / percent) + 0.01))
    own = [F.xxhash64(F.lit(t), size_class + up, F.get("mins", F.lit(t))) for t in range(trees) for up in (0, 1)]
    return sets.select("set", F.lit(None).cast("long").alias("above"), F.explode(F.array(*own)).alias("node"))


def classes(found: _Sets, recall: float = RECALL) -> DataFrame:
    """(set, root): every distinct set with the smallest one that it reaches over links."""
    sets = found.sets
    rows = staged(_roots(sets, trees_for(recall), found.percent), "path-nodes")
    label = sets.select("set", F.col("set").alias("root"))
    pairs = crowds = None
    for level in range(LEVELS + 1):
        # The set of the smallest hash is the same in nodes of nearly the same sets.
        first = F.min_by("set", F.xxhash64("set")).alias("first")
        sized = rows.groupBy("node").agg(F.count("*").alias("size"), F.first("above").alias("above"), first)
        sized = staged(sized.where("size > 1"), "path-sizes")
        small = rows.join(sized.where(F.col("size") <= SMALL).select("node"), "node").select("node", "set")
        few = _pairs(small.toDF("node", "a").join(small.toDF("node", "b"), "node").where("a < b"))
        pairs = few if pairs is None else pairs.union(few)
        large = sized.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        alike = F.col("size") >= CROWD * F.coalesce("above", 2 * F.col("size"))
        branching = ~alike & F.lit(level < LEVELS)
        crowd = F.when(alike, F.xxhash64(F.lit("first"), "first")).otherwise(F.xxhash64("node")).alias("crowd")
        more = rows.join(large.where(~branching).select("node", crowd), "node").select("crowd", "set")
        crowds = more if crowds is None else crowds.union(more)
        rows = staged(_children(rows.drop("above").join(large.where(branching).select("node", "size"), "node"), sets), "path-nodes")
    if crowds is not None:
        label = _of_crowds(staged(crowds.distinct(), "path-crowds"), label, found)
    return _merged(label, found.links(_apart(pairs, label)))


def _of_crowds(crowds: DataFrame, label: DataFrame, found: _Sets) -> DataFrame:
    """Classes (set, root) after all links within crowds, rows (crowd, set)."""
    # Smallest hashes choose the pivots, so that crowds of nearly the same sets have the same pivots; each
    # task keeps its own smallest before the shuffle.
    pivot = [F.min_by("set", F.xxhash64("set", F.lit(j))).alias(f"p{j}") for j in range(PIVOTS)]
    pivots = F.array_distinct(F.array(*[f"p{j}" for j in range(PIVOTS)])).alias("pivots")
    chosen = crowds.join(crowds.groupBy("crowd").agg(*pivot).select("crowd", pivots), "crowd")
    # A set meets each pivot once, not once for each of its crowds.
    met = chosen.groupBy("set").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
    star = _pairs(met.select(F.col("set").alias("a"), F.explode("pivots").alias("b")).where("a <> b"))
    label = _merged(label, found.links(_apart(star, label)))
    member = crowds.join(label, "set")
    of_class = member.groupBy("crowd", "root").agg(F.count("*").alias("n"))
    split = of_class.groupBy("crowd").agg(F.max_by("root", F.struct("n", "root")).alias("low"), F.max("n").alias("n"), F.sum("n").alias("size"))
    # Crowds that one class fills for the most part are compared together with others of that class.
    key = F.when(2 * F.col("n") >= F.col("size"), F.xxhash64(F.lit("main"), "low")).otherwise(F.col("crowd"))
    apart = split.where("n < size").select("crowd", key.alias("key"), "low")
    member = member.join(apart, "crowd").select(F.col("key").alias("crowd"), "set", "root", "low").distinct()
    member = staged(member, "crowd-sets")
    links = _crowd_pairs(member, found.whole(member.select("set").distinct()), found.percent)
    return _merged(label, staged(links, "crowd-links"))


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs of two classes."""
    pairs = pairs.distinct()
    known = pairs.join(label.toDF("a", "root_a"), "a").join(label.toDF("b", "root_b"), "b")
    return known.where("root_a <> root_b").select("a", "b")


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (set, root) after new links between sets; the links of classes alone are followed."""
    if links.isEmpty():
        return label
    between = links.join(label.toDF("a", "root_a"), "a").join(label.toDF("b", "root_b"), "b")
    roots = connected(between.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b"))
    joined = label.join(roots.toDF("node", "low"), F.col("root") == F.col("node"), "left")
    return staged(joined.select("set", F.coalesce("low", "root").alias("root")), "set-classes")


def components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    recall: float = RECALL,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: the smallest id reachable over links.

    Shingles are ``words`` words between ASCII white space, A-Z in lower case; fewer words are one shingle. Documents
    link when 100 * shared >= ``percent`` * all shingles of both, on whole sets. Null and empty texts have no
    shingles and link with nothing. Repeated rows stay rows. Null ids take no part in the minimum; where a
    component has no other, component_id is null. ``kept`` is id = component_id, null equal to null.
    An empty table gives an empty one; other columns are not read.

    A link at the threshold is met with probability ``recall``; components are surer, as other links hold
    them together. ``percent`` may be raised; the trees are made for 80 and more.
    """
    found = _Sets(docs, id_col, text_col, words, percent)
    label = classes(found, recall)
    known = found.sets.select("set", "k1", "k2", "n").join(label, "set").select("k1", "k2", "n", "root")
    low = found.rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("id").alias("low")).join(known, ["k1", "k2", "n"])
    heads = low.groupBy("root").agg(F.min("low").alias("component_id"))
    of_set = staged(known.join(heads, "root").select("k1", "k2", "n", "component_id"), "set-components")
    placed = found.rows.join(of_set, ["k1", "k2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    out = placed.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents whose id is the smallest of their component, with all their columns; null ids stay where
    their component has no other id."""
    found = components(docs, id_col, text_col, **options).where("NOT kept").select(F.col("id").alias("_dropped")).distinct()
    return docs.join(staged(found, "dropped-ids"), F.col(id_col).eqNullSafe(F.col("_dropped")), "left_anti")
