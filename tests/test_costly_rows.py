"""Rows that are small in bytes but costly are dealt over all cores, and stay so."""

from pyspark.sql import functions as F

from feedloom.catalog import QUERIES
from feedloom.plans import entries as plans
from feedloom.streaming.refresh import crawl_batch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_routed_pages_keep_their_partitions(spark):
    pages = spark.range(40).select(F.concat(F.lit("f"), "id").alias("feed_name"), F.lit("<p>").alias("html"), F.lit("u").alias("url"))
    registry = pages.select("feed_name", F.lit("time_articles").alias("rule_id"), F.lit(True).alias("enabled"))
    assert "REPARTITION_BY_NUM" in plan(plans.route_pages(pages, registry))


def test_detail_pages_are_chosen_before_they_are_read(spark):
    entry = "feed_name STRING, link STRING, rule_id STRING, date_patterns ARRAY<STRING>, detail STRING"
    entries = spark.createDataFrame([("f", "l", "r", ["yyyy-M-d"], None)], entry)
    bodies = spark.createDataFrame([("f", "l", "<p>x", 2), ("f", "l", "<p>y", 1)], "feed_name STRING, link STRING, html STRING, v INT")
    text = plan(plans.with_details(entries, bodies, ["v"]))
    assert text.count("REPARTITION_BY_NUM") == 2 and "Exchange" not in text.split("ArrowEvalPython")[0]
    assert text.rindex("ArrowEvalPython") < text.index("Window")


def test_pages_made_of_rows_are_dealt(spark):
    assert "REPARTITION_BY_NUM" in plan(QUERIES["scan_links"](spark, "/root/testdata/sf0.001"))


def test_frontier_has_few_files_of_a_bucket(spark, tmp_path):
    pages = spark.range(64).select(
        F.lit("f").alias("feed_name"),
        F.lit("dated_articles").alias("rule_id"),
        (F.col("id") + 1).cast("int").alias("page_no"),
        F.concat(F.lit('<div id="content"><article><h1><a href="/'), "id", F.lit('">t</a></h1></article></div>')).alias("html"),
    )
    found = crawl_batch(pages.repartition(8), 0, str(tmp_path), rules=["dated_articles"])
    assert found.count() == 64
    for kept in ("items", "pages"):
        assert len(list(tmp_path.glob(f"{kept}/batch_id=0/bucket=*/*.parquet"))) == 1
