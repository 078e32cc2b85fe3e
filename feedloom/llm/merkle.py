"""Merkle manifest of a dataset: bitmap-rank coordinates and slot arrays.

Leaves of one group (a source) stand in order of their ids. A leaf's place is found without
sorting: the ids of a group are bits of bitmaps, one for each 2^15 neighbouring ids. Every task
makes bitmaps of its own rows, equal ones are merged by OR, and popcounts of all bitmaps are summed up to
a directory. A leaf's place is then the directory's entry of its bitmap, plus that of its block in
the bitmap, plus the bits before its own. Places are keys: each level puts the digests of ``FANOUT``
neighbours into the slots of one array, whose digest is a node of the next level.

Proofs go down the same levels: a run hands each slot the digests to its left and right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import prefix_sums
from feedloom.session import staged

FANOUT = 16
#: Ids of one bitmap, as a power of two, and bytes of one block of its popcount directory.
BITS = 15
BLOCK = 64
#: Null ids are dealt to so many cells by the start of their digest.
CELL_DIGITS = 4


def digest(text: Column) -> Column:
    """SHA-256 as lowercase hex digits."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length, so that no two rows read alike: ``-`` for null, else bytes, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _group_key(group: str) -> Column:
    """Sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit(""))


def coordinates(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adds ``place`` to leaves (key, id, leaf, ...); also gives (key, total) of all groups.

    Places of a group count from 0: null ids first, by their digests, then ascending ids. Rows that share an id, and
    rows without one, are numbered by a window inside their bitmap or cell; all others by rank alone.
    """
    has_id = F.col("id").isNotNull()
    cell = F.conv(F.substring("leaf", 1, CELL_DIGITS), 16, 10).cast("long")
    rows = leaves.withColumns(
        {
            "has_id": has_id,
            "cell": F.when(has_id, F.shiftright("id", BITS)).otherwise(cell),
            "bit": F.when(has_id, F.col("id").bitwiseAND(F.lit((1 << BITS) - 1))).otherwise(F.lit(0)).cast("long"),
        }
    )
    where = ["key", "has_id", "cell"]
    maps = rows.groupBy(*where).agg(F.count("*").alias("n"), F.bitmap_construct_agg("bit").alias("bits"))
    maps = maps.withColumn("clean", F.col("has_id") & (F.bitmap_count("bits") == F.col("n")))
    maps = prefix_sums(staged(maps, "id-bitmaps"), where, "n", "before")
    totals = staged(maps.groupBy("key").agg(F.sum("n").alias("total"), F.min("before").alias("start")), "group-sizes")
    blocks = F.transform(
        F.sequence(F.lit(0), F.lit((1 << BITS) // 8 // BLOCK - 1)),
        lambda i: F.bitmap_count(F.substring("bits", F.lit(1), i * BLOCK)).cast("int"),
    )
    directory = maps.join(totals.select("key", "start"), "key").select(
        *where, "clean", (F.col("before") - F.col("start")).alias("base"),
        F.when(F.col("clean"), F.col("bits")).alias("bits"), F.when(F.col("clean"), blocks).alias("blocks"),
    )
    placed = rows.join(staged(directory, "id-ranks"), where)
    byte = F.shiftright("bit", 3).cast("int")
    block = F.floor(byte / BLOCK).cast("int")
    own = F.conv(F.hex(F.substring("bits", byte + 1, F.lit(1))), 16, 10).cast("long")
    under = own.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("bit").bitwiseAND(F.lit(7)).cast("int")).cast("long") - 1)
    rank = F.get("blocks", block) + F.bitmap_count(F.substring("bits", block * BLOCK + 1, byte % BLOCK)) + F.bit_count(under)
    clean = placed.where("clean").withColumn("rank", rank.cast("long"))
    crowd = Window.partitionBy(*where).orderBy("id", "leaf")
    crowded = placed.where("NOT clean").withColumn("rank", (F.row_number().over(crowd) - 1).cast("long"))
    both = clean.unionByName(crowded)
    return (
        both.withColumn("place", F.col("base") + F.col("rank")).select(*leaves.columns, "place"),
        totals.select("key", "total"),
    )


def _levels(total: str) -> Column:
    """How often a group of so many leaves is reduced until one node remains."""
    return sum((F.when(F.col(total) > FANOUT**i, 1).otherwise(0) for i in range(16)), F.lit(0))


class Tree:
    """Runs of all levels of one tree per key, as written tables.

    ``leaves`` (key, place, leaf, ...) carry further columns along in the lowest runs.
    """

    def __init__(self, leaves: DataFrame, totals: DataFrame) -> None:
        self.sizes = staged(totals.select("key", _levels("total").alias("levels")), "tree-sizes")
        self.height = self.sizes.agg(F.max("levels")).first()[0] or 0
        sized = leaves.join(self.sizes, "key")
        self.alone = sized.where("levels = 0")
        rest = [c for c in leaves.columns if c not in ("key", "place")]
        self.runs: list[DataFrame] = []
        tops = [self.alone.select("key", F.col("leaf").alias("top"))]
        nodes = sized.where("levels > 0").select("key", "levels", "place", *rest)
        for level in range(self.height):
            slot = F.struct((F.col("place") % FANOUT).alias("slot"), *[c for c in nodes.columns if c in rest])
            runs = nodes.groupBy("key", "levels", F.floor(F.col("place") / FANOUT).alias("run")).agg(
                F.array_sort(F.collect_list(slot)).alias("slots")
            )
            runs = staged(runs, f"merkle-{level}")
            self.runs.append(runs)
            joined = digest(F.array_join(F.transform("slots", lambda s: s["leaf"]), ""))
            nodes = runs.select("key", "levels", F.col("run").alias("place"), joined.alias("leaf"))
            tops.append(nodes.where(F.col("levels") == level + 1).select("key", F.col("leaf").alias("top")))
            nodes = nodes.where(F.col("levels") > level + 1)
        found = tops[0]
        for more in tops[1:]:
            found = found.union(more)
        self.tops = staged(found, "merkle-tops")

    def leaves_with_chains(self, chains: DataFrame) -> DataFrame:
        """The leaves with ``chain``: (left, right) digests on the way from the leaf up to ``chains`` (key, chain)."""
        above = None
        for level in range(self.height - 1, -1, -1):
            heads = self.sizes.where(F.col("levels") == level + 1).join(chains, "key").select("key", F.lit(0).cast("long").alias("run"), "chain")
            above = heads if above is None else heads.unionByName(above)
            runs = self.runs[level].join(above, ["key", "run"])
            one = runs.select("key", "run", "chain", "slots", F.posexplode("slots").alias("at", "own"))
            side = lambda part: F.array_join(F.transform(part, lambda s: s["leaf"]), "")
            left = side(F.slice("slots", F.lit(1), F.col("at")))
            right = side(F.slice("slots", F.col("at") + 2, F.lit(FANOUT)))
            chain = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("chain"))
            place = F.col("run") * FANOUT + F.col("own.slot")
            if level:
                above = one.select("key", place.alias("run"), chain.alias("chain"))
            else:
                above = one.select("key", place.alias("place"), "own.*", chain.alias("chain")).drop("slot")
        lone = self.alone.join(chains, "key").drop("levels")
        return lone if above is None else above.unionByName(lone)


def manifest(
    docs: DataFrame,
    values: Sequence[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    tampered: dict[str, Column] | None = None,
    suspect: Column | None = None,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    A leaf is the digest of the columns ``values``. Groups are trees of their own, whose tops are leaves of the
    whole tree, in the order of the groups, null first. ``proof_sha256`` stands for the siblings from the leaf
    to the root; ``folded_root`` is worked out from them and from the row as it is found, which for rows
    that are ``suspect`` has the values of ``tampered``. ``verified`` tells whether it is the root.

    Null values are values of their own. Null ids stand first in their group. Rows that share an id stand in
    order of their digests; equal rows are leaves of their own and may trade places. Ids must be whole numbers (a text
    that is none counts as null). No rows give no rows. Texts are read once; afterwards a row is an id, a group and two digests.

    A group with a third of all rows has bitmaps of 2^15 ids and runs of 16 like any other. Only rows that
    share an id, or without one the first digits of the digest, meet in one task.
    """
    tampered, suspect = tampered or {}, F.lit(False) if suspect is None else F.coalesce(suspect, F.lit(False))
    own = row_digest([F.col(c) for c in values])
    changed = row_digest([tampered.get(c, F.col(c)) for c in values])
    leaves = staged(
        docs.select(
            _group_key(group_col).alias("key"),
            F.expr(f"try_cast(`{id_col}` AS BIGINT)").alias("id"),
            own.alias("leaf"),
            F.when(suspect, changed).alias("found"),
        ),
        "leaves",
    )
    placed, totals = coordinates(leaves)
    tree = Tree(placed, totals)
    numbered = prefix_sums(tree.tops.withColumn("one", F.lit(1).cast("long")), ["key"], "one", "place")
    groups = numbered.select(F.lit("").alias("key"), "place", F.col("top").alias("leaf"), F.col("key").alias("group"))
    count = numbered.agg(F.count("*").alias("total")).where("total > 0").select(F.lit("").alias("key"), "total")
    whole = Tree(groups, count)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    top = whole.tops.select(F.col("top").alias("root"))
    chains = whole.leaves_with_chains(whole.tops.select("key", nothing.alias("chain")))
    chains = chains.select(F.col("group").alias("key"), F.col("leaf").alias("subroot"), "chain")
    chains = staged(chains.crossJoin(F.broadcast(top)), "group-chains")  # one root
    found = tree.leaves_with_chains(chains.select("key", "chain"))
    out = found.join(chains.select("key", "subroot", "root"), "key")
    proof = digest(F.array_join(F.transform("chain", lambda c: F.concat(c["left"], c["right"])), ""))
    folded = F.aggregate(
        "chain", F.coalesce("found", "leaf"), lambda h, c: digest(F.concat(c["left"], h, c["right"]))
    )
    return out.select("id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
