"""Registration of queries, and the small pieces their sources share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.dates import fallback_date
from feedloom.functions.text import collapse_space, unescape_common
from feedloom.functions.urls import canonical_url, host
from feedloom.operators.dedupe import first_valid
from feedloom.operators.filters import non_blank
from feedloom.session import dealt, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(published: Column | str, name: str = "published") -> Column:
    """Dates leave a query as text, so that every engine shows them alike."""
    return F.date_format(published, "yyyy-MM-dd HH:mm:ss").alias(name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Group-ready partitions, as many as the cluster can use."""
    return dealt(df, *keys)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name on the cluster's shared storage, for queries that write and read back."""
    return f"{scratch_folder(spark, purpose)}/rows"


# --- pieces of SQL ---------------------------------------------------------------------


def sql_stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


def sql_fallback(link: str) -> str:
    return f"(TIMESTAMP '2023-01-01' + to_days((('0x' || substr(md5({link}), 1, 8))::BIGINT % 730)::INT))"


def sql_unescape(value: str) -> str:
    for entity, plain in [
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&apos;", "''"),
        ("&nbsp;", "\xa0"),
        ("&copy;", "\xa9"),
        ("&middot;", "\xb7"),
        ("&amp;", "&"),
    ]:
        value = f"replace({value}, '{entity}', '{plain}')"
    return value


def sql_collapse(value: str) -> str:
    return rf"trim(regexp_replace({value}, '[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}]+', ' ', 'g'))"


# Pages as entries: host as feed, cleaned URL as link, first heading as title.
PAGE_ENTRIES = rf"""
page_entries AS (
  SELECT page_id,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) AS feed_name,
         rtrim(split_part(split_part(url, '#', 1), '?', 1), '/') AS link,
         {sql_collapse(sql_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))} AS title
  FROM pages),
first_pages AS (
  SELECT * FROM page_entries WHERE title <> '' AND link <> ''
  QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY page_id) = 1),
dated_pages AS (
  SELECT feed_name, link, title, page_id AS seq,
         CASE WHEN page_id % 9 <> 0 THEN {sql_fallback("link")} END AS published
  FROM first_pages)
"""


def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.regexp_extract("html", "<h1>(.*?)</h1>", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        host(F.col("url")).alias("feed_name"),
        canonical_url(F.substring_index("url", "#", 1)).alias("link"),
        collapse_space(unescape_common(heading)).alias("title"),
    )


def dated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of all page hosts; every ninth page stays without a date."""
    chosen = first_valid(page_entries(spark, sf_dir), non_blank(), ["page_id"])
    return chosen.select(
        "feed_name",
        "link",
        "title",
        F.col("title").alias("description"),
        F.lit(None).cast("string").alias("category"),
        F.when(F.col("page_id") % 9 != 0, fallback_date(F.col("link"))).alias("published"),
        F.col("page_id").alias("seq"),
    )
