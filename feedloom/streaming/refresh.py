"""Incremental refresh as a stream of page snapshots.

What is known lives in the store, not in operator state: entries never expire, so there is
no watermark that would be right. Each micro-batch adds the links the store lacks, in a
folder of its own, so a repeated batch gives the same store.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedloom.operators.merge import added_entries, first_copies
from feedloom.plans import entries as plans
from feedloom.session import dealt
from feedloom.sources.store import append_entry_batch, compact_entry_batches, feed_bucket, read_entry_batches


def refresh_batch(
    fresh: DataFrame, batch_id: int, store_path: str, source: str, updated_at: str | datetime
) -> None:
    """Merge one batch of fresh entries into the store.

    The batch is small next to the store and is looked at twice, so it is kept for the time
    of the merge; a lost executor only means working it out again. Of the store only the buckets of the
    batch's feeds are read. New entries are numbered without gaps behind those of these buckets.
    """
    spark = fresh.sparkSession
    batch = first_copies(fresh).persist()
    try:
        buckets = [r.bucket for r in batch.select(feed_bucket().alias("bucket")).distinct().collect()]  # BUCKETS at most
        stored = read_entry_batches(spark, store_path, source, before=batch_id, buckets=buckets)
        added = added_entries(batch, stored, few=True, dense=True)
        append_entry_batch(added, store_path, source, batch_id, updated_at)
        compact_entry_batches(spark, store_path, source, batch_id)
    finally:
        batch.unpersist()


def stream_refresh(
    spark: SparkSession,
    pages_path: str,
    schema: StructType | str,
    store_path: str,
    checkpoint_path: str,
    extract: Callable[[DataFrame], DataFrame],
    updated_at: str | datetime,
    max_files: int = 1000,
) -> StreamingQuery:
    """Read every page file that is new since the last run, then stop.

    ``extract`` turns a batch of pages into entries (``plans.entries.site_entries`` or your
    own). Both folders belong on shared storage. Batch numbers belong to a checkpoint, so
    the checkpoint names the source of the batches: a new checkpoint over the same pages
    finds all links known and adds nothing.
    """
    source = hashlib.md5(checkpoint_path.encode()).hexdigest()
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(pages_path)
    return (
        pages.writeStream.foreachBatch(
            lambda batch, batch_id: refresh_batch(extract(batch), batch_id, store_path, source, updated_at)
        )
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


_PAGES = "feed_name STRING, rule_id STRING, page_no INT, collection_id STRING"
_CANDIDATES = (
    f"{_PAGES}, section INT, pos INT, link STRING, title STRING, description STRING, category STRING, "
    "published TIMESTAMP_NTZ, usable BOOLEAN, valid BOOLEAN, dedupe STRING"
)


def _keep(rows: DataFrame, folder: str, batch_id: int) -> None:
    # The rebalance makes few files of a bucket, however many tasks have rows of it.
    out = rows.withColumn("bucket", feed_bucket()).hint("rebalance", "bucket").write.mode("overwrite")
    out.partitionBy("bucket").parquet(f"{folder}/batch_id={int(batch_id)}")


def _known(spark: SparkSession, folder: str, schema: str, batch_id: int, feeds: DataFrame, buckets: list[int]) -> DataFrame:
    """What this and earlier batches have kept of the given feeds."""
    kept = spark.read.schema(f"{schema}, batch_id BIGINT, bucket INT").parquet(folder)
    kept = kept.where(F.col("bucket").isin(buckets) & (F.col("batch_id") <= batch_id))
    return kept.drop("batch_id", "bucket").join(feeds, "feed_name", "left_semi")


def crawl_batch(
    pages: DataFrame,
    batch_id: int,
    frontier_path: str,
    rules: Collection[str] | None = None,
    rulebook: DataFrame | None = None,
    page_limit: int | None = None,
) -> DataFrame:
    """Entries that a crawl would have found on the pages of this and all earlier batches, of this batch's feeds.

    The frontier table keeps every page's number and its items, keyed by feed. A crawl that ended before a missing page
    goes on from there when the page arrives, with the items of later pages that came before. Pages are
    walked once, in their own batch. A batch that is repeated replaces what it kept.
    """
    spark = pages.sparkSession
    listed = pages.where("rule_id <> 'embedded_json'")
    for column, value in (("page_no", 1), ("collection_id", "")):
        if column not in listed.columns:
            listed = listed.withColumn(column, F.lit(value))
    listed = listed.withColumn("page_no", F.col("page_no").cast("int"))
    walked = dealt(listed, "feed_name", "page_no", "collection_id")  # a batch may be a few large files
    _keep(plans.listing_candidates(walked, rules, rulebook), f"{frontier_path}/items", batch_id)
    _keep(listed.select(*plans.PAGE), f"{frontier_path}/pages", batch_id)
    mine = spark.read.schema(f"{_PAGES}, bucket INT").parquet(f"{frontier_path}/pages/batch_id={int(batch_id)}")
    feeds = mine.select("feed_name").distinct()
    buckets = [r.bucket for r in mine.select("bucket").distinct().collect()]  # BUCKETS numbers at most
    items = _known(spark, f"{frontier_path}/items", _CANDIDATES, batch_id, feeds, buckets)
    shown = _known(spark, f"{frontier_path}/pages", _PAGES, batch_id, feeds, buckets)
    found = plans.resolve_entries(plans.crawl_candidates(items, shown, page_limit), rulebook=rulebook)
    if rules is not None and "embedded_json" not in rules:
        return found
    return found.unionByName(plans.embedded_entries(pages.where("rule_id = 'embedded_json'")))


def stream_crawl(
    spark: SparkSession,
    pages_path: str,
    schema: StructType | str,
    store_path: str,
    frontier_path: str,
    checkpoint_path: str,
    updated_at: str | datetime,
    rules: Collection[str] | None = None,
    rulebook: DataFrame | None = None,
    page_limit: int | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """``stream_refresh`` over raw pages of crawled sites, in whatever order their pages arrive.

    The store holds the same links as after one run over all pages. An entry that comes on several pages is kept as the
    first batch found it. The frontier belongs to the checkpoint: a new checkpoint needs a new one.
    """
    source = hashlib.md5(checkpoint_path.encode()).hexdigest()
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(pages_path)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        entries = crawl_batch(batch, batch_id, frontier_path, rules, rulebook, page_limit)
        refresh_batch(entries.drop("rule_id"), batch_id, store_path, source, updated_at)

    return pages.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
