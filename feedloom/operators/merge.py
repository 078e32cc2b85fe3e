"""Merging fresh entries into a store that never forgets and never changes an entry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.dedupe import KEY, first_by
from feedloom.operators.joins import join_dimension
from feedloom.operators.ordering import number_rows
from feedloom.session import staged


def new_entries(
    fresh: DataFrame, stored: DataFrame, keys: Sequence[str] = KEY, unique: bool = False, few: bool = False
) -> DataFrame:
    """Fresh rows whose link the store does not hold.

    Put this before any costly work on the rows (detail pages, entity decoding): Spark does
    not move a join below a Python function by itself.

    ``unique`` says that no link comes twice in ``fresh``; then one join against the distinct
    keys of the store does it. Otherwise one link may fill much of ``fresh``: the store is cut
    down to the links that occur there at all, and the rows of a hot link are spread over
    several tasks. ``few`` asks for the same cut when ``fresh`` is small next to the store:
    Spark then broadcasts its keys if their measured size allows, and the store is scanned
    but not shuffled. Cutting reads ``fresh`` twice.
    """
    known = stored.select(*keys)
    if few or not unique:
        known = known.join(fresh.select(*keys).distinct(), list(keys), "left_semi")
    if unique:
        return fresh.join(known.distinct(), list(keys), "left_anti")
    return join_dimension(fresh, known.distinct(), list(keys), "left_anti", spread_by=["seq"])


def first_copies(fresh: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """The first copy of each link; two snapshots of one place on a page differ by their text."""
    return first_by(fresh, ["seq", *[c for c in ("title", "description") if c in fresh.columns]], keys)


def added_entries(
    fresh: DataFrame, stored: DataFrame, keys: Sequence[str] = KEY, few: bool = False, dense: bool = False
) -> DataFrame:
    """The rows a merge adds: first copy of each unknown link, numbered after the stored ones.

    ``seq`` continues behind the largest stored ``seq`` (one scalar), so that for equal
    dates stored entries stay ahead of new ones. ``dense`` counts the added rows in their order instead of
    adding their own ``seq``, which may have large gaps: then the numbers of a store that is merged
    into again and again grow with its rows only. It runs a job when it is called.
    """
    last = F.coalesce(stored.agg(F.max("seq")).scalar(), F.lit(-1).cast("bigint"))
    added = new_entries(first_copies(fresh, keys), stored, keys, unique=True, few=few)
    if not dense:
        return added.withColumn("seq", F.col("seq") + last + F.lit(1))
    numbered = number_rows(added, [], [F.col("seq"), *map(F.col, keys)], "_place")
    return numbered.withColumn("seq", F.col("_place") + last).drop("_place")


def merge_entries(fresh: DataFrame, stored: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Every stored row unchanged, plus the first copy of each unknown link.

    ``is_new`` tells the two apart. Stored rows are not shuffled: only their distinct keys
    take part in the join.
    """
    kept = stored.withColumn("is_new", F.lit(False))
    added = added_entries(fresh, stored, keys).withColumn("is_new", F.lit(True))
    return kept.unionByName(added, allowMissingColumns=True)


def merge_stats(merged: DataFrame) -> DataFrame:
    """How many entries each feed gained."""
    return merged.groupBy("feed_name").agg(
        F.count_if("is_new").alias("added"), F.count(F.lit(1)).alias("total")
    )


def enrich_details(
    listing: DataFrame,
    details: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEY,
    order: Sequence[str] = (),
) -> DataFrame:
    """Fill columns of listing rows from detail rows; what the detail lacks stays as it was.

    The listing is de-duplicated before (one row per key), so no key can be hot. Of several detail
    rows of one key the first by ``order`` counts as a whole, values of two rows are never mixed; ties go by a hash of
    the values.
    """
    whole = F.struct(*columns)
    first = details.groupBy(*keys).agg(F.min_by(whole, F.struct(*order, F.xxhash64(*columns))).alias("_detail"))
    joined = listing.join(first, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col("_detail")[c], F.col(c)) for c in columns}).drop("_detail")


def refresh_entries(
    fresh: DataFrame, stored: DataFrame, full: bool | Column = False, keys: Sequence[str] = KEY
) -> DataFrame:
    """Full or incremental refresh, decided feed by feed in one job.

    A feed is replaced by its fresh entries when ``full`` holds for it or the store has
    nothing of it; otherwise the two are merged. ``full`` may be a condition on
    ``feed_name``. A feed without fresh entries keeps what it has, in either mode. ``fresh`` is worked out
    once, by a job that runs when this is called.
    """
    some, full = full is not False, full if isinstance(full, Column) else F.lit(full)
    # Fresh entries come from a walk over pages: they are worked out once and written, each with a number of its own.
    fresh = staged(fresh.withColumn("_each", F.monotonically_increasing_id()), "fresh-entries")
    feeds = stored.select("feed_name", F.lit(True).alias("_known")).union(fresh.select("feed_name", F.lit(False)))
    seen = feeds.groupBy("feed_name").agg(F.bool_or("_known").alias("_known"), (~F.bool_and("_known")).alias("_fresh"))
    modes = seen.select("feed_name", (F.col("_fresh") & (full | ~F.col("_known"))).alias("_replace"))
    kept = stored
    if some:
        kept = join_dimension(stored, modes, ["feed_name"], "left", spread_by=["link"])
        kept = kept.where(~F.coalesce("_replace", F.lit(False))).drop("_replace")
    flagged = join_dimension(fresh, modes, ["feed_name"], spread_by=["link"])
    # One way for both modes: nothing is kept of a replaced feed, so its rows meet no known key, and their own numbers
    # hold its copies apart. Both steps use one partitioning.
    own = [*keys, "_each"]
    flagged = flagged.withColumn("_each", F.when(F.col("_replace"), F.col("_each")).otherwise(F.lit(-1).cast("bigint")))
    known = kept.select(*keys).distinct().withColumn("_each", F.lit(-1).cast("bigint"))
    added = first_copies(flagged, own).join(known, own, "left_anti")
    behind = F.coalesce(kept.agg(F.max("seq")).scalar(), F.lit(-1).cast("bigint")) + F.lit(1)
    added = added.withColumn("seq", F.col("seq") + F.when(F.col("_replace"), F.lit(0)).otherwise(behind)).drop("_each", "_replace")
    return kept.withColumn("is_new", F.lit(False)).unionByName(
        added.withColumn("is_new", F.lit(True)), allowMissingColumns=True
    )
