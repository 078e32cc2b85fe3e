"""Queries for numbered listing pages."""

from pyspark.sql import functions as F

from feedloom.catalog.base import query, scratch, spread, sql_stamp, stamp, table
from feedloom.operators import pagination
from feedloom.plans.entries import listing_candidates, site_entries
from feedloom.sources import store
from feedloom.streaming.refresh import stream_crawl

# Twenty events make a page, sixty-five page numbers a site. Links repeat, so crawls run dry.
# Two kinds of page show no links, one page number in some sites is missing. Crawls end at the
# reference's page 50.
PAGE_LIMIT = 50
SHOWN = """
listed AS (
  SELECT DISTINCT 'site-' || event_id // 1300 AS feed_name, (event_id % 1300) // 20 + 1 AS page_no,
         event_id // 1300 AS site
  FROM events
  WHERE NOT (event_id // 1300 % 3 = 1 AND (event_id % 1300) // 20 + 1 = 7)),
shown AS (
  SELECT event_id, 'site-' || event_id // 1300 AS feed_name, (event_id % 1300) // 20 + 1 AS page_no,
         event_id % 20 AS pos, ts,
         'https://site.example/u/' || CASE WHEN event_id // 1300 % 3 = 2 THEN event_id ELSE user_id END AS link
  FROM events
  WHERE NOT (event_id // 1300 % 3 = 1 AND (event_id % 1300) // 20 + 1 = 7)
    AND NOT ((event_id % 1300) // 20 + 1 IN (3, 4) AND event_id // 1300 % 4 = 1))
"""

FRONTIER = f"""
{SHOWN},
debut AS (SELECT feed_name, link, min(page_no) AS page_no FROM shown GROUP BY feed_name, link),
counted AS (
  SELECT l.feed_name, l.page_no, count(d.link) AS n_new
  FROM listed l LEFT JOIN debut d ON d.feed_name = l.feed_name AND d.page_no = l.page_no
  GROUP BY l.feed_name, l.page_no),
walked AS (
  SELECT *, lag(page_no) OVER (PARTITION BY feed_name ORDER BY page_no) AS prev_page,
         lag(n_new) OVER (PARTITION BY feed_name ORDER BY page_no) AS prev_new
  FROM counted),
stops AS (
  SELECT feed_name, min(page_no) AS stop_page FROM walked
  WHERE (page_no > 1 AND prev_page <> page_no - 1) OR (page_no >= 3 AND n_new = 0 AND prev_new = 0) OR page_no > 50
  GROUP BY feed_name),
collected AS (
  SELECT s.* FROM shown s LEFT JOIN stops t ON t.feed_name = s.feed_name
  WHERE s.page_no < coalesce(t.stop_page, 1000)
  QUALIFY row_number() OVER (PARTITION BY s.feed_name, s.link ORDER BY s.page_no, s.pos) = 1)
"""


def _site(key):
    return F.floor(key / 1300)


def _listed(spark, sf_dir):
    key = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.concat(F.lit("site-"), _site(key).cast("string")).alias("feed_name"),
        F.lit("").alias("collection_id"),
        (F.floor((key % 1300) / 20) + 1).alias("page_no"),
        (key % 20).alias("pos"),
        F.concat(
            F.lit("https://site.example/u/"),
            F.when(_site(key) % 3 == 2, key).otherwise(F.col("user_id")).cast("string"),
        ).alias("link"),
    )
    return rows.where(~((_site(key) % 3 == 1) & (F.col("page_no") == 7)))


def _has_links():
    return ~(F.col("page_no").isin(3, 4) & (_site(F.col("event_id")) % 4 == 1))


@query(f"""
WITH {FRONTIER}
SELECT c.feed_name, c.page_no, c.n_new, c.page_no < coalesce(t.stop_page, 1000) AS crawled
FROM counted c LEFT JOIN stops t USING (feed_name) WHERE c.page_no <= 50""")
def crawl_pages(spark, sf_dir):
    listed = _listed(spark, sf_dir)
    return pagination.crawl_pages(listed.where(_has_links()), listed, PAGE_LIMIT).select("feed_name", "page_no", "n_new", "crawled")


@query(f"WITH {FRONTIER} SELECT feed_name, link, page_no, pos FROM collected")
def pagination_frontier(spark, sf_dir):
    listed = _listed(spark, sf_dir)
    rows = pagination.pagination_frontier(listed.where(_has_links()), listed, PAGE_LIMIT)
    return rows.select("feed_name", "link", "page_no", "pos")


def _crawl_html(spark, sf_dir):
    """The same pages as markup, one article per event."""
    listed = _listed(spark, sf_dir)
    article = F.concat(
        F.lit('<article><h1><a href="'),
        F.col("link"),
        F.lit('">Post '),
        F.col("event_id").cast("string"),
        F.lit('</a></h1><p class="date">Posted on '),
        F.date_format("ts", "EEEE MMMM d, yyyy"),
        F.lit("</p></article>"),
    )
    shown = F.when(_has_links(), article).otherwise("")
    return (
        spread(listed, "feed_name", "page_no")
        .groupBy("feed_name", "page_no")
        .agg(F.array_sort(F.collect_list(F.struct("pos", shown.alias("a")))).alias("found"))
        .select(
            "feed_name",
            F.lit("dated_articles").alias("rule_id"),
            F.col("page_no").cast("int").alias("page_no"),
            F.concat(
                F.lit('<div id="content">'), F.array_join(F.transform("found", lambda x: x["a"]), ""), F.lit("</div>")
            ).alias("html"),
        )
    )


@query(f"""
WITH {FRONTIER}
SELECT feed_name, link, 'Post ' || event_id AS title, {sql_stamp("date_trunc('day', ts)")} AS published FROM collected""")
def crawl_entries(spark, sf_dir):
    """Full crawl: walk the pages, cut each site at its frontier, keep the first copy."""
    rows = site_entries(_crawl_html(spark, sf_dir), rules=["dated_articles"], page_limit=PAGE_LIMIT)
    return rows.select("feed_name", "link", "title", stamp("published"))


@query(f"""
WITH {SHOWN}
SELECT feed_name, link, 'Post ' || event_id AS title, {sql_stamp("date_trunc('day', ts)")} AS published
FROM shown WHERE page_no = 1
QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY pos) = 1""")
def first_page_entries(spark, sf_dir):
    """Incremental run: page 1 only."""
    rows = site_entries(_crawl_html(spark, sf_dir), crawl=False, rules=["dated_articles"])
    return rows.select("feed_name", "link", "title", stamp("published"))


@query(f"""
WITH {SHOWN}
SELECT feed_name, count(*) AS n_items, count(DISTINCT page_no) AS n_pages FROM shown GROUP BY feed_name""")
def listing_items(spark, sf_dir):
    """Every item of every page, before any filter."""
    rows = listing_candidates(_crawl_html(spark, sf_dir), ["dated_articles"])
    return rows.groupBy("feed_name").agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("page_no").alias("n_pages")
    )


FRONTIER_ALL = FRONTIER.replace(" OR page_no > 50", "")


@query(f"WITH {FRONTIER_ALL} SELECT feed_name, link, page_no, pos FROM collected")
def crawl_all_pages(spark, sf_dir):
    """The frontier without a last page."""
    listed = _listed(spark, sf_dir)
    rows = pagination.pagination_frontier(listed.where(_has_links()), listed)
    return rows.select("feed_name", "link", "page_no", "pos")


@query(f"WITH {FRONTIER_ALL} SELECT feed_name, link, 1::BIGINT AS n FROM collected")
def stream_crawl_store(spark, sf_dir):
    """Raw pages scrambled over files and batches: the store ends with what one crawl of all pages finds."""
    root = scratch(spark, "crawl-stream")
    pages = _crawl_html(spark, sf_dir).repartition(9, F.xxhash64("feed_name", "page_no"))
    pages.write.parquet(f"{root}/pages")
    stream_crawl(
        spark, f"{root}/pages", pages.schema, f"{root}/store", f"{root}/frontier", f"{root}/checkpoint",
        "2024-06-01 00:00:00", rules=["dated_articles"], max_files=3,
    ).awaitTermination()
    stored = store.read_entry_batches(spark, f"{root}/store")
    prefix = F.regexp_replace("link", "^https://jamiehurst.co.uk", "")
    return stored.groupBy("feed_name", prefix.alias("link")).agg(F.count(F.lit(1)).alias("n"))
