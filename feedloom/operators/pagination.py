"""How far a crawl of numbered listing pages goes, worked out from the pages themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.dedupe import first_by
from feedloom.operators.joins import join_dimension

# Fixed value: the run of pages without news that ends a crawl.
EMPTY_RUN = 2

CRAWL = ["feed_name", "collection_id"]


def _within(rows: DataFrame, page_limit: int | None) -> DataFrame:
    return rows if page_limit is None else rows.where(F.col("page_no") <= page_limit)


def crawl_pages(entries: DataFrame, pages: DataFrame | None = None, page_limit: int | None = None) -> DataFrame:
    """Per page: how many links are new on it, and whether the crawl reads it.

    A link is new on the lowest page that shows it. The crawl ends before a missing page,
    and after two pages in a row without news; page 1 never counts as empty. ``pages``
    lists pages that exist but may show no entry at all; without it the pages are those
    the entries name. ``page_limit`` is the last page ever read; without it there is none.
    """
    shown = _within(entries, page_limit)
    listed = _within(pages if pages is not None else entries, page_limit)
    # min() and count() shrink every link and page inside the tasks before they are shuffled.
    debut = shown.groupBy(*CRAWL, "link").agg(F.min("page_no").alias("page_no"))
    fresh = debut.groupBy(*CRAWL, "page_no").agg(F.count(F.lit(1)).alias("n_new"))
    every = listed.select(*CRAWL, "page_no").distinct()
    counted = every.join(fresh, [*CRAWL, "page_no"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))

    # One row per page of a crawl from here on.
    walk = Window.partitionBy(*CRAWL).orderBy("page_no")
    gap = (F.col("page_no") > 1) & (F.coalesce(F.lag("page_no").over(walk), F.lit(0)) != F.col("page_no") - 1)
    quiet = (F.col("page_no") > EMPTY_RUN) & (F.col("n_new") == 0) & (F.lag("n_new").over(walk) == 0)
    # A quiet page is still read, only what comes after it is not; it holds no news anyway.
    stops = counted.withColumn("_stops", F.coalesce(gap | quiet, F.lit(False)))
    stopped = F.max("_stops").over(walk.rowsBetween(Window.unboundedPreceding, 0))
    return stops.withColumn("crawled", ~stopped).drop("_stops")


def pagination_frontier(
    entries: DataFrame, pages: DataFrame | None = None, page_limit: int | None = None
) -> DataFrame:
    """The entries a crawl collects: each link once, from the first crawled page that shows it.

    Collections are crawled each by itself; a link that two collections of a feed show comes
    once for each (apply ``first_by`` on feed and link after it for one).
    """
    last = (
        crawl_pages(entries, pages, page_limit)
        .where("crawled")
        .groupBy(*CRAWL)
        .agg(F.max("page_no").alias("_last"))
    )
    first = first_by(_within(entries, page_limit), ["page_no", "pos"], [*CRAWL, "link"])
    return join_dimension(first, last, CRAWL, spread_by=["link"]).where(F.col("page_no") <= F.col("_last")).drop("_last")
