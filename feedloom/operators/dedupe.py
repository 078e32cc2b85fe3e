"""Who wins when one link comes several times.

All of these shuffle on ``(feed_name, link)``, never on the feed alone, and all shrink
each task's copies of a link to one row before the shuffle (Spark's partial window group
limit or partial aggregation), so a link that fills a third of the table stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("feed_name", "link")


def first_by(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = KEY) -> DataFrame:
    """One row per key: the first under ``order``, which must break every tie."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def first_valid(df: DataFrame, valid: Column, order: Sequence[str] = ("pos",), keys: Sequence[str] = KEY):
    """Invalid rows are dropped first; the first valid copy stays."""
    return first_by(df.where(valid), order, keys)


def first_seen(df: DataFrame, valid: Column, order: Sequence[str] = ("pos",), keys: Sequence[str] = KEY):
    """The first copy counts even when it is broken, and then hides the good ones after it."""
    return first_by(df, order, keys).where(valid)


def first_dated(
    df: DataFrame, valid: Column, date: str = "published", pos: str = "pos", keys: Sequence[str] = KEY
) -> DataFrame:
    """A dated copy beats an undated one, but stands where the first copy stood."""
    rest = [c for c in df.columns if c not in keys]
    winner = F.min_by(F.struct(*rest), F.struct(F.col(date).isNull(), F.col(pos)))
    chosen = df.where(valid).groupBy(*keys).agg(winner.alias("_w"), F.min(pos).alias("_first"))
    fields = [F.col("_first").alias(c) if c == pos else F.col(f"_w.{c}").alias(c) for c in rest]
    return chosen.select(*keys, *fields)


def first_section(
    df: DataFrame,
    valid: Column,
    order: Sequence[str] = ("section", "pos"),
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """Earlier sections of a page win over later ones; position decides inside a section."""
    return first_by(df.where(valid), order, keys)


def union_sources(*sources: DataFrame, rank: str = "source_rank") -> DataFrame:
    """Stack entry sources, numbered in the order given; missing columns become NULL."""
    ranked = [s.withColumn(rank, F.lit(i)) for i, s in enumerate(sources)]
    stacked = ranked[0]
    for s in ranked[1:]:
        stacked = stacked.unionByName(s, allowMissingColumns=True)
    return stacked
