"""Plans that must hold when one key has a third of all rows."""

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.operators.dedupe import first_valid
from feedloom.operators.filters import non_blank
from feedloom.operators.joins import join_dimension
from feedloom.operators.merge import added_entries, new_entries
from feedloom.operators.ordering import feed_order, number_rows
from feedloom.operators.render import feed_items, render_feeds
from feedloom.plans.entries import choose_entries, listing_candidates, site_entries
from feedloom.plans.sites import site_channels
from feedloom.session import checkpoint_dir

N = 30_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """One feed holds nearly everything, one of its links a third of all rows, one date most of them."""
    n = F.col("id")
    return spark.range(N, numPartitions=6).select(
        F.when(n % 50 == 0, "small").otherwise("hot").alias("feed_name"),
        F.when(n % 3 == 0, "https://x/hot").otherwise(F.concat(F.lit("https://x/"), n.cast("string"))).alias("link"),
        F.concat(F.lit("Title "), n.cast("string")).alias("title"),
        F.lit("d").alias("description"),
        F.lit(None).cast("string").alias("category"),
        F.when(n % 5 == 0, F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz"))
        .when(n % 5 == 1, F.date_add(F.lit("2020-01-01").cast("date"), (n % 700).cast("int")).cast("timestamp_ntz"))
        .alias("published"),
        n.alias("seq"),
    )


def test_hot_link_shrinks_before_the_shuffle(skewed):
    chosen = first_valid(skewed, non_blank(), ["seq"])
    before_shuffle = plan(chosen).split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle and "row_number(), 1, Partial" in before_shuffle
    assert chosen.where("link = 'https://x/hot'").count() == 2


def test_candidates_are_combined_before_the_shuffle(spark):
    pages = spark.createDataFrame([("f", "time_articles", "<p>")], "feed_name STRING, rule_id STRING, html STRING")
    text = plan(choose_entries(listing_candidates(pages, ["time_articles"])))
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text and "partial_min_by" in text.split("Exchange hashpartitioning")[-1]


def test_large_feed_is_numbered_in_slices(spark, skewed):
    order = [F.col("published").desc_nulls_first(), F.col("seq").desc()]
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("feed_name").orderBy(*order)).cast("bigint"))
    columns = ["feed_name", "seq", "n"]
    # So few rows would be gathered into one slice.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = number_rows(skewed, ["feed_name"], order, "n")
        assert "Window [row_number()" not in plan(sliced)
        assert sliced.select(columns).exceptAll(plain.select(columns)).isEmpty()
        assert sliced.count() == N
        spread = sliced.where("feed_name = 'hot'").groupBy(F.spark_partition_id()).count()
        assert spread.count() > 4 and spread.agg(F.max("count")).first()[0] < N // 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbering_without_a_group_with_nulls_and_taken_names(spark):
    rows = spark.range(100).select(F.col("id").alias("at_"), F.when(F.col("id") > 9, "x").alias("slice_"))
    whole = number_rows(rows, [], [F.col("at_").desc()], "n").collect()
    assert all(r["n"] == 100 - r["at_"] for r in whole) and len(whole) == 100
    grouped = number_rows(rows, ["slice_"], [F.col("at_").asc()], "n").collect()
    assert sorted(r["n"] for r in grouped if r["slice_"] is None) == list(range(1, 11)) and len(grouped) == 100
    assert number_rows(rows.limit(0), ["slice_"], [F.col("at_").asc()], "n").isEmpty()


def test_undated_last(skewed):
    ends = feed_order(skewed, undated="last").groupBy("feed_name").agg(
        F.max("feed_pos").alias("n"), F.max(F.when(F.col("published").isNotNull(), F.col("feed_pos"))).alias("dated")
    )
    dated, n = ends.where("feed_name = 'hot'").select("dated", "n").first()
    assert dated == n - skewed.where("feed_name = 'hot' AND published IS NULL").count()


def test_documents_hold_a_bounded_number_of_items(spark, skewed):
    items = feed_items(feed_order(skewed))
    documents = render_feeds(items, site_channels(spark), "2026-01-01 00:00:00", "https://f", items_per_document=500)
    counts = documents.select("feed_name", "part", (F.size(F.split("rss_xml", "<item>")) - 1).alias("n"))
    total, most, parts = counts.agg(F.sum("n"), F.max("n"), F.count("n")).first()
    assert (total, most, parts) == (N, 500, 61)


def test_dimension_join_spreads_a_hot_key(spark, skewed):
    dimension = spark.createDataFrame([("hot", 1), ("small", 2)], "feed_name STRING, d INT")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dimension(skewed, dimension, ["feed_name"], spread_by=["seq"])
        assert "_salt" in plan(joined).split("hashpartitioning(")[1]
        assert joined.count() == N and joined.agg(F.sum("d")).first()[0] == N + N // 50
        gone = join_dimension(skewed, dimension.where("d = 1"), ["feed_name"], "left_anti", spread_by=["seq"])
        assert gone.count() == N // 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_fresh_link_is_spread(spark, skewed):
    stored = skewed.where("seq < 100")
    left = new_entries(skewed, stored)
    assert "_salt" in plan(left)
    known = {(r["feed_name"], r["link"]) for r in stored.select("feed_name", "link").collect()}
    expected = sum((r["feed_name"], r["link"]) not in known for r in skewed.select("feed_name", "link").collect())
    assert left.count() == expected
    few = added_entries(skewed, stored, few=True)
    many = added_entries(skewed, stored)
    assert few.exceptAll(many).isEmpty() and few.count() == many.count()


def test_scan_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame(
        [("f", "time_articles", 1, "<p>", "u", "unused")],
        "feed_name STRING, rule_id STRING, page_no INT, html STRING, url STRING, other STRING",
    ).write.parquet(path)
    text = plan(site_entries(spark.read.parquet(path), crawl=False, rules=["time_articles"]))
    assert "EqualTo(page_no,1)" in text
    assert text.count("ArrowEvalPython [walk(") == 1  # every page is walked once
    assert "ReadSchema: struct<feed_name:string,rule_id:string,page_no:int,html:string>" in text


def test_checkpoint_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_dir(spark) == configured if configured else checkpoint_dir(spark)
