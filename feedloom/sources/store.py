"""The entry store: what is already known of each feed."""

from __future__ import annotations

import re
from collections.abc import Collection
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.dates import as_of, fallback_date, iso_date
from feedloom.schema import ENTRY, ENTRY_COLUMNS, STORE_DOCUMENT


def read_store_documents(spark: SparkSession, path: str, glob: str = "*_posts.json") -> DataFrame:
    """JSON documents, one per feed (``<feed_name>_posts.json``), as typed entries.

    A truncated document counts as empty.
    """
    documents = (
        spark.read.schema(STORE_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", glob)
        .json(path)
    )
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)_posts\.json$", 1)
    good = documents.select(F.url_decode(name).alias("feed_name"), "last_updated", "entries", "_corrupt_record")
    rows = good.where("_corrupt_record IS NULL").select(
        "feed_name", "last_updated", F.posexplode("entries").alias("pos", "_e")
    )
    return typed_entries(rows.select("feed_name", "last_updated", F.col("pos").cast("bigint").alias("seq"), "_e.*"))


def typed_entries(rows: DataFrame) -> DataFrame:
    """Date texts to dates. A bad text gets the stand-in date of its link; NULL stays NULL."""
    text = F.col("date")
    stand_in = fallback_date(F.coalesce("link", F.lit("")))
    published = F.when(text.isNotNull(), F.coalesce(iso_date(text), stand_in))
    return rows.withColumn("published", published).drop("date")


def write_entry_store(entries: DataFrame, path: str, updated_at: str | datetime) -> None:
    """Replace the stored entries of every feed in ``entries``; other feeds stay as they are.

    ``path`` must not be read by the plan of ``entries``: write the next version to a new
    folder, or append batches with ``append_entry_batch``. The rebalance lets AQE split a
    large feed over several files and gather small ones.
    """
    stamped = entries.select(*ENTRY_COLUMNS).withColumn("last_updated", as_of(updated_at))
    (
        stamped.hint("rebalance", "feed_name")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("feed_name")
        .parquet(path)
    )


def read_entry_store(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet store, with or without batches; no store yet means no entries."""
    schema = f"{ENTRY}, last_updated TIMESTAMP_NTZ"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


#: Feeds share so many folders of a store; a batch reads those of its own feeds.
BUCKETS = 64
#: So many runs of one size become one run of the next size.
FANOUT = 8


def feed_bucket() -> Column:
    """The folder of a feed."""
    return F.pmod(F.xxhash64("feed_name"), F.lit(BUCKETS)).cast("int")


def append_entry_batch(
    entries: DataFrame, path: str, source: str, batch_id: int, updated_at: str | datetime
) -> None:
    """Write the entries one batch of one source adds as a run of its own, dealt over the buckets of their feeds.

    Known entries never change, so a merge only ever adds rows and no run is ever rewritten in place. Repeating a batch
    replaces its own run and nothing else; if that batch is part of a compacted run already, nothing is written.
    """
    spark = entries.sparkSession
    if any(first <= batch_id <= last and first < last for _, first, last in _runs(spark, path, source)):
        return
    stamped = entries.select(*ENTRY_COLUMNS).withColumn("last_updated", as_of(updated_at))
    _write_run(stamped, path, source, int(batch_id), int(batch_id))


def compact_entry_batches(spark: SparkSession, path: str, source: str, batch_id: int, fanout: int = FANOUT) -> None:
    """Call after batch ``batch_id``: gather the largest complete block of runs that ends with it.

    Blocks hold ``fanout``, ``fanout`` squared, ... batches, so a row is rewritten once for each size and the number of
    runs grows with the logarithm of the number of batches. A compacted run counts as soon as it is complete, and hides
    the runs that it was made of. Their files stay for those who still read them, until ``drop_compacted_runs``.
    """
    block = 1
    while (batch_id + 1) % (block * fanout) == 0:
        block *= fanout
    first = batch_id + 1 - block
    parts = [run for run in _visible(_runs(spark, path, source)) if first <= run[1] and run[2] <= batch_id]
    if len(parts) > 1:
        rows = _read_runs(spark, path, parts).drop("bucket")
        _write_run(rows, path, source, first, batch_id)


def drop_compacted_runs(spark: SparkSession, path: str, source: str) -> None:
    """Delete the runs that a compacted run holds as well. No job may be reading them."""
    runs = _runs(spark, path, source)
    for run in set(runs) - set(_visible(runs)):
        folder = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(path, *run))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_entry_batches(
    spark: SparkSession,
    path: str,
    source: str | None = None,
    before: int | None = None,
    buckets: Collection[int] | None = None,
) -> DataFrame:
    """All batches of a batch store; of ``source`` only those before a given one.

    ``buckets`` reads the folders of these buckets only.
    """
    runs = _runs(spark, path)
    if before is not None:
        runs = [run for run in runs if run[0] != source or run[2] < before]
    rows = _read_runs(spark, path, _visible(runs))
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(*buckets) if buckets else F.lit(False))
    return rows.drop("bucket")


#: A run is (source, first batch, last batch).
_Run = tuple[str, int, int]


def _run_folder(path: str, source: str, first: int, last: int) -> str:
    if not re.fullmatch(r"[\w.-]+", source):
        raise ValueError(f"not a source name: {source}")
    return f"{path.rstrip('/')}/source={source}/first={first}/last={last}"


def _write_run(rows: DataFrame, path: str, source: str, first: int, last: int) -> None:
    # The rebalance gathers the small buckets of a batch and splits a bucket with a large feed.
    dealt = rows.withColumn("bucket", feed_bucket()).hint("rebalance", "bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(_run_folder(path, source, first, last))


def _read_runs(spark: SparkSession, path: str, runs: Collection[_Run]) -> DataFrame:
    schema = f"{ENTRY}, last_updated TIMESTAMP_NTZ, source STRING, first BIGINT, last BIGINT, bucket INT"
    if not runs:
        return spark.createDataFrame([], schema).drop("source", "first", "last")
    rows = spark.read.schema(schema).option("basePath", path.rstrip("/"))
    return rows.parquet(*[_run_folder(path, *run) for run in sorted(runs)]).drop("source", "first", "last")


def _runs(spark: SparkSession, path: str, source: str = "*") -> list[_Run]:
    """The complete runs: those whose write left its mark."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/source={source}/first=*/last=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    named = [re.search(r"/source=([^/]+)/first=(\d+)/last=(\d+)/_SUCCESS$", f.getPath().toString()) for f in found]
    return [(m[1], int(m[2]), int(m[3])) for m in named if m]


def _visible(runs: Collection[_Run]) -> list[_Run]:
    """Runs that no longer run holds."""
    held: list[_Run] = []
    for run in sorted(runs, key=lambda r: (r[0], r[1], -r[2])):
        if not (held and held[-1][0] == run[0] and run[2] <= held[-1][2]):
            held.append(run)
    return held


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(folder) and len(files.listStatus(folder)) > 0
