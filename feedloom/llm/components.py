"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import drop_folder, scratch_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of these. Here b < a always."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b")))


def unsettled(links: DataFrame) -> int:
    """Number of nodes that keep distinct links (a, b), b < a, from being stars: two smaller neighbours, or one below a
    smaller and above a larger node. Stars are components, and their centres the smallest nodes."""
    one, none = F.lit(1), F.lit(0)
    ends = links.select(F.col("a").alias("node"), one.alias("up"), none.alias("down")).union(links.select("b", none, one))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").count()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b); root is its component's smallest node.

    Loops and repeated links do no harm; an empty table gives an empty one. Each round writes the
    links to the shared folder, so a lost executor costs at most one round; the last is the one that leaves
    stars alone. The number of rounds grows with the logarithm of the longest chain. No step gathers a component: smallest
    neighbours are aggregated before the shuffle, and joins on a node with many links can be split.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark, "components")
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    turn = 0
    while True:
        links.write.parquet(f"{folder}/{turn}")
        links = spark.read.schema("a long, b long").parquet(f"{folder}/{turn}")
        if turn:
            drop_folder(spark, f"{folder}/{turn - 1}")
        if not unsettled(links):
            break
        turn += 1
        links = _small_star(_large_star(links).distinct()).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", "b").distinct()
    )
