"""Feed order, and row numbers inside a group that may be larger than one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import staged


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``row_number()`` per group (or over all rows, without one) that needs no group in one task.

    One way for every size: rows are sorted by range over all tasks and written once to the shared
    checkpoint folder, by a job of its own. A row's number is its place in its slice plus the rows that its group has
    in earlier slices. A hot group spreads over as many slices as it needs; only one count for each
    slice of a group meets in a window. ``order`` must break every tie.
    """
    longest = max(map(len, df.columns))
    at, part, n, shift = (x.ljust(longest + 1, "_") for x in ("at", "slice", "n", "shift"))  # names that no column has
    ranged = df.orderBy(*group, *order).withColumns({at: F.monotonically_increasing_id(), part: F.spark_partition_id()})
    rows = staged(ranged, "numbered")
    sizes = rows.groupBy(*group, part).agg(F.count(F.lit(1)).alias(n), F.min(at).alias(shift))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(n).over(before), F.lit(0))
    offsets = sizes.select(*[F.col(c).alias(f"{c}{shift}") for c in group], F.col(part).alias(n), (earlier - F.col(shift) + 1).alias(shift))
    same = [F.col(c).eqNullSafe(F.col(f"{c}{shift}")) for c in group]
    placed = rows.join(offsets, [*same, F.col(part) == F.col(n)])
    return placed.select(*df.columns, (F.col(at) + F.col(shift)).cast("bigint").alias(name))


def sort_entries(entries: DataFrame) -> DataFrame:
    """Oldest first, undated last; equal dates in order of arrival."""
    return entries.orderBy("feed_name", *_oldest_first())


def sort_positions(entries: DataFrame) -> DataFrame:
    """The order of ``sort_entries`` as data: ``sort_pos`` counts the entries of each feed from 1."""
    return number_rows(entries, ["feed_name"], _oldest_first(), "sort_pos")


def _oldest_first() -> list[Column]:
    return [F.col("published").asc_nulls_last(), F.col("seq").asc(), F.col("link").asc()]


def feed_order(entries: DataFrame, undated: str = "first") -> DataFrame:
    """Position in the document: the exact reverse of ``sort_entries``.

    Newest first, undated entries on top, equal dates latest arrival first.
    ``undated="last"`` moves undated entries to the end.
    """
    date = F.col("published")
    by_date = date.desc_nulls_first() if undated == "first" else date.desc_nulls_last()
    order = [by_date, F.col("seq").desc(), F.col("link").desc()]
    return number_rows(entries, ["feed_name"], order, "feed_pos")
