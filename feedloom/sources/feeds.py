"""Feed documents on disk: writing, scanning and parsing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.dates import parse_rfc822
from feedloom.functions.text import strip
from feedloom.schema import FEED_DOCUMENT


def write_feeds(documents: DataFrame, path: str) -> None:
    """One file per document under ``feed_name=<name>/``.

    Feeds without a document in this run are not touched, so an empty result never replaces
    a feed. All documents of a feed that is written are replaced together.
    """
    (
        documents.repartition("feed_name", "part")
        .select("feed_name", "rss_xml")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 1)
        .partitionBy("feed_name")
        .text(path)
    )


def feed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Feed files as (feed_name, xml). The name comes from ``feed_name=<name>/`` or ``feed_<name>.xml``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    escaped = F.nullif(F.regexp_extract("path", r"/feed_name=([^/]+)/", 1), F.lit(""))
    folder = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    plain = F.regexp_extract("path", r"/feed_([^/]+)\.xml$", 1)
    return files.load(path).select(
        F.coalesce(folder, plain).alias("feed_name"),
        F.expr("make_valid_utf8(CAST(content AS STRING))").alias("xml"),
    )


def parse_feeds(documents: DataFrame) -> DataFrame:
    """Documents (feed_name, xml) parsed: channel, ``broken`` and ``first``, the position its items start at.

    A further part of a feed says so in its channel; every other document starts at 1.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt_record",
        "ignoreSurroundingSpaces": "false",
    }
    channel = F.substring_index("xml", "<item>", 1)
    start = F.regexp_extract(channel, r"<opensearch:startIndex\b[^>]*>\s*(\d{1,18})\s*<", 1)
    first = F.coalesce(F.nullif(start, F.lit("")).cast("bigint"), F.lit(1).cast("bigint"))
    parsed = documents.select(
        "feed_name", first.alias("first"), F.from_xml("xml", FEED_DOCUMENT, options).alias("_d")
    )
    return parsed.select(
        "feed_name", "first", "_d.channel", F.col("_d._corrupt_record").isNotNull().alias("broken")
    )


def feed_states(parsed: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row per feed with ``broken``. A feed of ``expected`` without any readable file is broken.

    An empty file gives no row at all in a scan, so only ``expected`` can bring it to light.
    """
    states = parsed.groupBy("feed_name").agg(F.bool_or("broken").alias("broken"))
    if expected is None:
        return states
    wanted = expected.select("feed_name").distinct()
    return wanted.join(states, "feed_name", "full").withColumn("broken", F.coalesce("broken", F.lit(True)))


def feed_items(parsed: DataFrame) -> DataFrame:
    """The items of readable documents in document order, dates parsed (forgivingly)."""
    rows = parsed.select("feed_name", "first", F.posexplode("channel.item").alias("pos", "_i"))
    position = F.col("first") + F.col("pos")
    return rows.select(
        "feed_name",
        position.alias("feed_pos"),
        "_i.title",
        "_i.link",
        "_i.description",
        "_i.guid",
        "_i.category",
        parse_rfc822(F.col("_i.pubDate")).alias("published"),
        F.col("_i.pubDate").alias("pub_date"),
    )


def read_feeds(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Scan and parse in one step."""
    return parse_feeds(feed_files(spark, path, glob))


def feed_links(items: DataFrame) -> DataFrame:
    """Distinct trimmed links per feed. Unreadable feeds have none."""
    link = strip(F.col("link"))
    return items.select("feed_name", link.alias("link")).where("link <> ''").distinct()
