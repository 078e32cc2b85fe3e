"""Page snapshots. Fetching is not part of this package: pages arrive as a table or as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def page_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The page table (Parquet): page_id, url, html, plus whatever routing columns it has."""
    return spark.read.parquet(path)


def page_files(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Raw page files as (url, content); the path stands for the URL."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return files.load(path).select(F.col("path").alias("url"), "content")


def decode_pages(pages: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Bytes to text under a fixed charset, whatever the server claimed.

    A malformed byte sequence becomes U+FFFD instead of failing the job.
    """
    if charset.upper() in ("UTF-8", "UTF8"):
        text = F.expr("make_valid_utf8(CAST(content AS STRING))")
    else:
        text = F.decode("content", charset)
    return pages.withColumn("html", text).drop("content")
