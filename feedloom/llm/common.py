"""Small pieces that several of the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import staged

#: Fixed value: the characters that separate words, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column) -> Column:
    """The text itself; a null text counts as an empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text in joins, as two numbers."""
    return F.xxhash64(text), F.xxhash64(text, F.lit("second"))


def bounded(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A narrow written table, marked for broadcast if it has at most ``rows`` rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def slices(texts: pd.Series, budget: int) -> Iterator[pd.Series]:
    """Cut a batch of texts so that each piece holds about ``budget`` characters.

    A longer single text is a piece of its own; texts are never cut.
    """
    start = held = 0
    for at, size in enumerate(texts.str.len()):
        if at > start and held + size > budget:
            yield texts.iloc[start:at]
            start, held = at, 0
        held += size
    if start < len(texts):
        yield texts.iloc[start:]


def prefix_sums(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows that come earlier in ``order``.

    Rows are dealt to ranges of ``order`` and written; the sums of whole ranges, one row for each, are
    added up apart. No task holds more than its range.
    """
    part, done = fresh(df, "range_part"), fresh(df, "range_start")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id()), "ranges")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(part).agg(F.sum(value).alias(done)).select(
        part, F.coalesce(F.sum(done).over(earlier), F.lit(0)).alias(done)
    )
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col(done)
    return ranged.join(F.broadcast(starts), part).withColumn(name, summed.cast("long")).drop(part, done)
