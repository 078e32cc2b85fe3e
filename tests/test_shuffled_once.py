"""What goes through a shuffle: orders and not their markup, each entry once, a dimension only where it is met."""

import re
from datetime import datetime
from itertools import permutations

from pyspark.sql import functions as F

from feedloom.catalog import QUERIES
from feedloom.operators.joins import join_dimension
from feedloom.plans import entries as plans
from feedloom.session import dealt

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text, keys):
    """Shuffles on these columns, whatever their numbers in the plan."""
    names = ", ".join(rf"{k}#\d+" for k in keys)
    return len(re.findall(rf"hashpartitioning\({names}, \d+\)", text))


def test_orders_are_spread_and_not_their_markup(spark):
    text = plan(QUERIES["site_news_cards"](spark, SF))
    below = text.split("REPARTITION_BY_NUM")[-1]
    assert "FileScan parquet [o_orderkey" in below and "<li>" in text and "<li>" not in below


def test_entries_are_not_shuffled_again_for_their_details(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("8", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            text = plan(QUERIES["site_note_links"](spark, SF))
            assert shuffles(text, ["feed_name", "link"]) == 2  # candidates and detail pages
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rules_share_the_shuffles_of_orders(spark):
    found = QUERIES["site_all_rules"](spark, SF)
    found.collect()
    final = plan(found).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 14  # before: none
    assert "explode(sequence" not in final and "isnotnull(cast(pmod" not in final


def test_dimension_is_copied_for_used_parts_only(spark):
    n = F.col("id")
    facts = spark.range(400).select(F.when(n < 300, "hot").otherwise(F.concat(F.lit("f"), n)).alias("k"), n.cast("string").alias("u"))
    facts = facts.unionByName(spark.createDataFrame([(None, "x"), ("gone", "y")], "k STRING, u STRING"))
    dimension = spark.range(1000).select(F.when(n == 0, "hot").when(n == 1, None).otherwise(F.concat(F.lit("f"), n)).alias("k"), n.alias("d"))
    wanted = facts.join(dimension, "k").collect()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dimension(facts, dimension, ["k"], spread_by=["u"], costly=True)
        assert sorted(joined.select("k", "u", "d").collect()) == sorted(wanted)
        left = join_dimension(facts, dimension, ["k"], "left", spread_by=["u"], costly=True)
        assert left.count() == 402 and left.where("d IS NULL").count() == 2
        assert "explode" not in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_wide_rows_lie_in_as_many_partitions_as_other_shuffles(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "77")
    try:
        rows = spark.range(5)
        assert dealt(rows, "id", wide=True).rdd.getNumPartitions() == 77 and dealt(rows, "id").rdd.getNumPartitions() == 32
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def candidates(spark, rows):
    """One link of one feed, as (page, section, pos, collection, title, published, valid, rule's policy)."""
    return spark.createDataFrame(
        [("f", f"r-{p}", n, c, s, i, "l", t, t, None, d, True, v, p) for n, s, i, c, t, d, v, p in rows],
        "feed_name STRING, rule_id STRING, page_no INT, collection_id STRING, section INT, pos INT, link STRING, title STRING, "
        "description STRING, category STRING, published TIMESTAMP_NTZ, usable BOOLEAN, valid BOOLEAN, dedupe STRING",
    )


def test_winner_and_place_do_not_depend_on_the_order_of_rows(spark):
    day = datetime(2026, 1, 2)
    cases = [
        # snapshots of one page: one of them, whichever comes first
        ([(1, 0, 4, "", "b", day, True, "first_valid"), (1, 0, 4, "", "a", day, True, "first_valid")], ("a", 4)),
        # a dated copy at the place of the first one, on the first page only
        ([(1, 0, 2, "", "undated", None, True, "first_dated"), (1, 0, 5, "", "dated", day, True, "first_dated")], ("dated", 2)),
        ([(1, 0, 2, "", "undated", None, True, "first_dated"), (2, 0, 0, "", "dated", day, True, "first_dated")], ("undated", 2)),
        # rules of two policies in one feed
        ([(1, 0, 3, "", "undated", None, True, "first_dated"), (1, 1, 0, "", "valid", day, True, "first_valid")], ("valid", 3)),
        ([(1, 1, 3, "", "dated", day, True, "first_dated"), (1, 0, 7, "", "valid", None, True, "first_valid")], ("valid", 7)),
        # the first one seen is broken and hides the next
        ([(1, 0, 0, "", "x", day, False, "first_seen"), (1, 0, 1, "", "good title", day, True, "first_seen")], None),
    ]
    for rows, wanted in cases:
        for order in permutations(rows):
            found = [(r["title"], r["seq"] & 0xFFFFFFFF) for r in plans.choose_entries(candidates(spark, order)).collect()]
            assert found == ([] if wanted is None else [wanted]), (order, found)


def test_texts_and_numbers_come_back_as_they_were(spark):
    rows = candidates(spark, [(3, 2, 9, "c", "t", None, True, "first_valid")]).drop("title", "description", "link", "valid")
    texts = [("a", "a", True), ("a", "b", True), ("a", None, True), (None, "b", True), (None, None, True), ("", "", True), ("a", "a", None), ("x", "y", False)]
    cases = spark.createDataFrame([(f"l{n}", *t) for n, t in enumerate(texts)], "link STRING, title STRING, description STRING, valid BOOLEAN")
    for policy in ("first_valid", "first_seen", "first_dated", None):
        chosen = plans.choose_entries(rows.withColumn("dedupe", F.lit(policy).cast("string")).crossJoin(cases)).collect()
        found = sorted((r["link"], r["title"], r["description"], r["seq"]) for r in chosen)
        assert found == [(f"l{n}", t, d, (3 << 40) + (2 << 32) + 9) for n, (t, d, v) in enumerate(texts) if v], policy


def test_details_go_by_order_then_by_the_hash_of_the_body(spark):
    entry = "feed_name STRING, link STRING, rule_id STRING, date_patterns ARRAY<STRING>, detail STRING"
    program = plans.builtin_rules(spark).where("rule_id = 'note_links'").first()["detail"]
    entries = spark.createDataFrame([("f", link, "r", ["yyyy-M-d"], program) for link in "abc"], entry)
    page = "<d-article><p>2026-01-0%d</p></d-article>"
    rows = [("f", "a", page % 2, 2), ("f", "a", page % 1, 1), ("f", "b", page % 3, None), ("f", "b", page % 4, None)]
    hashes = {n: spark.range(1).select(F.xxhash64(F.lit(page % n))).first()[0] for n in (3, 4)}
    for bodies in (rows, rows[::-1]):
        details = spark.createDataFrame(bodies, "feed_name STRING, link STRING, html STRING, v INT")
        found = {r["link"]: r["detail_date"] and r["detail_date"].day for r in plans.with_details(entries, details, ["v"]).collect()}
        assert found == {"a": 1, "b": min(hashes, key=hashes.get), "c": None}
