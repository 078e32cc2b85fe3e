"""The end of a feed: notice, waiting time, removal."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import as_of, whole_days
from feedloom.operators.joins import join_dimension

# Guid and title of a notice, and the days it stands before removal.
NOTICE_PREFIX = "deprecation-notice-"
NOTICE_TITLE = "[NOTICE] This feed is no longer maintained"
RETENTION_DAYS = 90


def _notice_guid():
    return F.concat(F.lit(NOTICE_PREFIX), F.col("feed_name"))


def checked_notices(notices: DataFrame, feeds: DataFrame) -> DataFrame:
    """The notices with ``known``: does the feed exist at all? Unknown ones are rejected."""
    known = feeds.select("feed_name").distinct().withColumn("known", F.lit(True))
    return notices.join(known, "feed_name", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def inject_notices(
    items: DataFrame, notices: DataFrame, feeds: DataFrame, moment: str | datetime
) -> DataFrame:
    """Items plus one notice in front of the first item of each feed that asks for it.

    ``notices`` has feed_name, message and alternative_url (may be NULL). A feed that already
    carries its notice stays as it is, so a second run changes nothing. ``feeds`` lists the
    feeds that exist: one without items gets its notice too, an unknown one gets none.
    """
    present = items.where(F.col("guid") == _notice_guid()).select("feed_name").distinct()
    wanted = (
        checked_notices(notices, feeds)
        .where("known")
        .join(present, "feed_name", "left_anti")
        .join(items.groupBy("feed_name").agg(F.min("feed_pos").alias("_first")), "feed_name", "left")
    )
    alternative = F.concat(F.lit("\n\nRecommended alternative: "), F.col("alternative_url"))
    has_alternative = F.col("alternative_url") != ""
    body = F.concat("message", F.coalesce(F.when(has_alternative, alternative), F.lit("")))
    rows = wanted.select(
        "feed_name",
        (F.coalesce("_first", F.lit(1)) - 1).cast("bigint").alias("feed_pos"),
        F.lit(NOTICE_TITLE).alias("title"),
        F.when(has_alternative, F.col("alternative_url")).alias("link"),
        body.alias("description"),
        _notice_guid().alias("guid"),
        F.lit(None).cast("string").alias("category"),
        as_of(moment).alias("published"),
    )
    return items.unionByName(rows)


def retirable_feeds(
    items: DataFrame, moment: str | datetime, threshold: int = RETENTION_DAYS
) -> DataFrame:
    """Feeds whose notice is strictly older than ``threshold`` days, with its age.

    The first notice with a readable date counts; broken ones before it are passed over.
    """
    readable = F.startswith("guid", F.lit(NOTICE_PREFIX)) & F.col("published").isNotNull()
    notice = (
        items.where(readable)
        .groupBy("feed_name")
        .agg(F.min_by("published", "feed_pos").alias("noticed_at"))
    )
    cutoff = as_of(moment) - F.expr(f"INTERVAL {int(threshold)} DAYS")
    return notice.where(F.col("noticed_at") < cutoff).withColumn(
        "age_days", whole_days(moment, F.col("noticed_at"))
    )


def retire_feeds(
    items: DataFrame, moment: str | datetime, threshold: int = RETENTION_DAYS, apply: bool = False
) -> DataFrame:
    """Dry run (default): the feeds that would go. Applied: the items that stay.

    Write the applied result to a new version of the table, never over the one being read.
    """
    going = retirable_feeds(items, moment, threshold)
    if not apply:
        return going
    return join_dimension(items, going.select("feed_name"), ["feed_name"], "left_anti", spread_by=["guid"])
