"""Crawls go beyond the fiftieth page."""

from pyspark.sql import functions as F

from feedloom.operators.pagination import crawl_pages, pagination_frontier
from feedloom.plans.entries import site_entries


def test_crawls_read_all_pages(spark):
    rows = spark.range(1, 61).select(
        F.lit("f").alias("feed_name"), F.lit("").alias("collection_id"), F.col("id").cast("int").alias("page_no"),
        F.lit(0).alias("pos"), F.concat(F.lit("l"), "id").alias("link"),
    )
    assert crawl_pages(rows).where("crawled").count() == 60
    assert pagination_frontier(rows).count() == 60
    assert pagination_frontier(rows, page_limit=50).count() == 50
    html = F.concat(
        F.lit('<div id="content"><article><h1><a href="https://s.example/'), "link",
        F.lit('">Post</a></h1><p class="date">Posted on Monday January 5, 2026</p></article></div>'),
    )
    pages = rows.select("feed_name", F.lit("dated_articles").alias("rule_id"), "page_no", html.alias("html"))
    assert site_entries(pages, rules=["dated_articles"]).count() == 60
    assert site_entries(pages, rules=["dated_articles"], page_limit=50).count() == 50
