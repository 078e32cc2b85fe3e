"""Health of the published feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import whole_days

# Fixed value: a feed is stale when its newest item is more whole days old than this.
STALE_DAYS = 60


def audit_feeds(
    items: DataFrame, feeds: DataFrame, moment: str | datetime, threshold: int = STALE_DAYS
) -> DataFrame:
    """One row per feed of ``feeds``: item count, newest date, status and message.

    ``items`` has feed_name and published (NULL when unreadable). ``feeds`` has feed_name and
    ``broken``, true when the document could not be parsed. Items are summed up inside the
    tasks and joined to the feeds as one row each, so a large feed costs nothing extra.
    """
    found = items.groupBy("feed_name").agg(F.count(F.lit(1)).alias("n"), F.max("published").alias("newest_date"))
    rows = feeds.join(found, "feed_name", "left").withColumns(
        {
            "item_count": F.when(F.col("broken"), 0).otherwise(F.coalesce("n", F.lit(0))).cast("bigint"),
            "newest_date": F.when(~F.col("broken"), F.col("newest_date")),
        }
    )
    age = whole_days(moment, F.col("newest_date"))
    count = F.concat(F.col("item_count").cast("string"), F.lit(" items"))
    day = F.date_format("newest_date", "yyyy-MM-dd")
    newest = F.concat(count, F.lit(", newest: "), day)
    status = (
        F.when(F.col("broken"), "ERROR")
        .when(F.col("item_count") == 0, "EMPTY")
        .when(age > threshold, "STALE")
        .otherwise("OK")
    )
    message = (
        F.when(F.col("broken"), "XML parse error")
        .when(F.col("item_count") == 0, "0 items")
        .when(F.col("newest_date").isNull(), F.concat(count, F.lit(", no parseable dates")))
        .when(age > threshold, F.concat(newest, F.lit(" ("), age.cast("string"), F.lit(" days ago)")))
        .otherwise(newest)
    )
    return rows.select("feed_name", "item_count", "newest_date", status.alias("status"), message.alias("message"))


def audit_summary(audit: DataFrame) -> DataFrame:
    """Feeds per status. Only ERROR and EMPTY make the audit fail; STALE is a warning."""
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("n_feeds")).withColumn(
        "failing", F.col("status").isin("ERROR", "EMPTY")
    )


def audit_failed(audit: DataFrame) -> DataFrame:
    """One row: does any feed make the audit fail?"""
    failing = F.coalesce(F.bool_or(F.col("status").isin("ERROR", "EMPTY")), F.lit(False))
    return audit.agg(failing.alias("failed"), F.count(F.lit(1)).alias("n_feeds"))
