"""The entry store, merging into it, and the stream."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.dates import fallback_date
from feedloom.operators.dedupe import first_dated, first_seen, first_valid
from feedloom.operators.filters import non_blank
from feedloom.operators.merge import merge_entries, refresh_entries
from feedloom.operators.pagination import pagination_frontier
from feedloom.plans.entries import site_entries
from feedloom.sources import store
from feedloom.sources.pages import decode_pages, page_files
from feedloom.streaming.refresh import refresh_batch, stream_refresh

ENTRY = "feed_name STRING, link STRING, title STRING, description STRING, category STRING, published TIMESTAMP_NTZ, seq BIGINT"
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, data):
    """(feed, link, title) in order of arrival."""
    return spark.createDataFrame([(f, k, t, "d", None, None, i) for i, (f, k, t) in enumerate(data)], ENTRY)


def shown(df):
    return sorted((r["feed_name"], r["link"], r["title"]) for r in df.collect())


cards = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.sampled_from(["", "t1", "t2"])), max_size=12)


@FEW
@given(fresh=cards, stored=cards)
def test_merge_like_the_sequential_loop(spark, fresh, stored):
    known, expected = {(f, k) for f, k, _ in stored}, list(stored)
    for f, k, t in fresh:
        if (f, k) not in known:
            known.add((f, k))
            expected.append((f, k, t))
    merged = merge_entries(frame(spark, fresh), frame(spark, stored))
    assert shown(merged) == sorted(expected)
    # Once more with the same fresh entries changes nothing.
    assert shown(merge_entries(frame(spark, fresh), merged.drop("is_new"))) == sorted(expected)


@FEW
@given(data=cards)
def test_dedupe_like_the_sequential_loop(spark, data):
    valid, seen, marked = {}, {}, set()
    for f, k, t in data:
        if t and (f, k) not in valid:
            valid[f, k] = t
        if (f, k) not in marked:
            marked.add((f, k))
            if t:
                seen[f, k] = t
    df = frame(spark, data)
    for parts in (1, 17):
        split = df.repartition(parts)
        assert shown(first_valid(split, non_blank(), ["seq"])) == sorted((*k, t) for k, t in valid.items())
        assert shown(first_seen(split, non_blank(), ["seq"])) == sorted((*k, t) for k, t in seen.items())


def test_dated_copy_takes_the_place_of_the_first(spark):
    day = datetime(2026, 1, 1)
    data = [("f", "a", "one", None, 1), ("f", "b", "two", day, 2), ("f", "a", "three", day, 3), ("f", "a", "four", day, 4), ("f", "a", "", day, 0)]
    df = spark.createDataFrame(data, "feed_name STRING, link STRING, title STRING, published TIMESTAMP_NTZ, pos BIGINT")
    assert sorted((r["link"], r["title"], r["pos"]) for r in first_dated(df, non_blank()).collect()) == [("a", "three", 1), ("b", "two", 2)]


@FEW
@given(pages=st.lists(st.tuples(st.integers(1, 9), st.lists(st.integers(0, 7), max_size=4)), max_size=9, unique_by=lambda p: p[0]))
def test_frontier_like_the_sequential_crawl(spark, pages):
    shelf = dict(pages)
    expected, quiet, number = set(shelf.get(1, [])), 0, 2
    while 1 in shelf and number in shelf and number <= 6 and quiet < 2:
        new = set(shelf[number]) - expected
        quiet = 0 if new else quiet + 1
        expected |= new
        number += 1
    rows = [("f", "", n, i, str(link)) for n, links in pages for i, link in enumerate(links)]
    shape = "feed_name STRING, collection_id STRING, page_no INT, pos INT, link STRING"
    listed = spark.createDataFrame([("f", "", n) for n in shelf], "feed_name STRING, collection_id STRING, page_no INT")
    found = pagination_frontier(spark.createDataFrame(rows, shape), listed, page_limit=6)
    got = sorted(r["link"] for r in found.collect())
    assert got == (sorted(map(str, expected)) if 1 in shelf else [])


def test_refresh_decides_feed_by_feed(spark):
    stored = frame(spark, [("a", "x", "old"), ("b", "x", "old"), ("c", "x", "old")])
    fresh = frame(spark, [("a", "x", "new"), ("a", "y", "new"), ("b", "x", "new"), ("d", "x", "new"), ("d", "x", "copy")])
    mixed = refresh_entries(fresh, stored, F.col("feed_name") == "b")
    assert shown(mixed) == [
        ("a", "x", "old"), ("a", "y", "new"), ("b", "x", "new"), ("c", "x", "old"), ("d", "x", "copy"), ("d", "x", "new"),
    ]


def test_store_documents(spark, tmp_path):
    (tmp_path / "good_posts.json").write_text(
        """{"last_updated": "2026-01-01T00:00:00+00:00",
            "entries": [{"title": "a", "link": "l1", "date": "2026-01-02T03:00:00+02:00", "description": "d"},
                        {"title": "b", "link": "l2", "date": "someday"}, {"title": "c", "link": "l3", "date": null},
                        {"title": "d", "date": "bad"}]}"""
    )
    (tmp_path / "cut_posts.json").write_text('{"last_updated": "x", "entries": [{"title": ')
    (tmp_path / "none_posts.json").write_text('{"last_updated": null, "entries": []}')
    rows = store.read_store_documents(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["feed_name"], r["title"], r["category"]) for r in rows] == [("good", t, None) for t in "abcd"]
    stand_in = spark.createDataFrame([("l2",), ("",)], "l STRING").select(fallback_date(F.col("l")).alias("d")).collect()
    assert [r["published"] for r in rows] == [datetime(2026, 1, 2, 1), stand_in[0]["d"], None, stand_in[1]["d"]]


def test_store_write_replaces_only_the_feeds_it_has(spark, tmp_path):
    path = str(tmp_path / "store")
    assert store.read_entry_store(spark, path).isEmpty()
    store.write_entry_store(frame(spark, [("a", "x", "1"), ("007", "x", "1"), ("b:c/d", "x", "1")]), path, "2026-01-01 00:00:00")
    store.write_entry_store(frame(spark, [("a", "y", "2")]), path, "2026-01-02 00:00:00")
    assert shown(store.read_entry_store(spark, path)) == [("007", "x", "1"), ("a", "y", "2"), ("b:c/d", "x", "1")]


def test_runs_are_compacted_and_pruned(spark, tmp_path):
    path, when = str(tmp_path / "store"), "2026-01-01 00:00:00"

    def feed(n):
        return frame(spark, [(f"feed{n % 3}", f"x{n}", f"t{n}")])

    def runs():
        return [run[1:] for run in store._visible(store._runs(spark, path))]

    for n in range(9):
        store.append_entry_batch(feed(n), path, "s", n, when)
        store.compact_entry_batches(spark, path, "s", n, fanout=2)
    everything = sorted((f"feed{n % 3}", f"x{n}", f"t{n}") for n in range(9))
    assert runs() == [(0, 7), (8, 8)]
    assert shown(store.read_entry_batches(spark, path)) == everything
    # A batch that is repeated: alone it replaces its run, in a compacted run it is there already.
    store.append_entry_batch(feed(8), path, "s", 8, when)
    store.append_entry_batch(feed(7), path, "s", 7, when)
    store.compact_entry_batches(spark, path, "s", 7, fanout=2)
    assert shown(store.read_entry_batches(spark, path)) == everything
    assert shown(store.read_entry_batches(spark, path, "s", before=8)) == [e for e in everything if e[1] != "x8"]
    # A run that was not written to its end does not count.
    (tmp_path / "store/source=s/first=8/last=9/bucket=1").mkdir(parents=True)
    assert runs() == [(0, 7), (8, 8)]
    store.drop_compacted_runs(spark, path, "s")
    assert shown(store.read_entry_batches(spark, path)) == everything
    bucket = spark.createDataFrame([("feed1",)], "feed_name STRING").select(store.feed_bucket()).first()[0]
    pruned = store.read_entry_batches(spark, path, buckets=[bucket])
    assert shown(pruned.where("feed_name = 'feed1'")) == [e for e in everything if e[0] == "feed1"]
    files = {f.split("bucket=")[1].split("/")[0] for f in pruned.inputFiles()}
    assert "PartitionFilters: [" in pruned._jdf.queryExecution().executedPlan().toString()
    assert str(bucket) in files and "bucket#" in pruned._jdf.queryExecution().executedPlan().toString()
    assert store.read_entry_batches(spark, path, buckets=[]).isEmpty()


def test_merged_again_and_again_numbers_stay_dense(spark, tmp_path):
    path = str(tmp_path / "store")
    far = 1 << 61  # added up, four of these overflow
    for n in range(5):
        rows = [("f", f"l{n}{i}", "t", None, None, None, far + i) for i in (1, 0)]
        refresh_batch(spark.createDataFrame(rows, ENTRY), n, path, "s", "2026-01-01 00:00:00")
    got = [(r.link, r.seq) for r in store.read_entry_batches(spark, path).orderBy("seq").collect()]
    assert got == [(f"l{n}{i}", 2 * n + i) for n in range(5) for i in (0, 1)]


def test_refresh_works_out_fresh_entries_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def walked(title):
        seen.add(1)
        return title

    fresh = frame(spark, [("a", "x", "new"), ("a", "y", "new"), ("b", "x", "new"), ("d", "x", "new")])
    stored = frame(spark, [("a", "x", "old"), ("b", "x", "old")])
    refreshed = refresh_entries(fresh.withColumn("title", walked("title")), stored, F.col("feed_name") == "b")
    assert shown(refreshed) == [("a", "x", "old"), ("a", "y", "new"), ("b", "x", "new"), ("d", "x", "new")]
    assert seen.value == 4


def test_forced_utf8(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<p>café —</p>".encode())
    (tmp_path / "b.html").write_bytes(b"<p>\xff</p>")
    pages = decode_pages(page_files(spark, str(tmp_path)))
    assert sorted(r["html"] for r in pages.collect()) == ["<p>café —</p>", "<p>�</p>"]


def test_stream_from_pages_to_store(spark, tmp_path):
    def article(link):
        return f'<article><h2>{link}</h2><a href="/blog/{link}">x</a></article>'

    shape = "feed_name STRING, rule_id STRING, page_no INT, html STRING"
    source, target = str(tmp_path / "pages"), str(tmp_path / "store")

    def snapshot(links):
        html = "".join(article(k) for k in links)
        spark.createDataFrame([("f", "time_articles", 1, html)], shape).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        stream_refresh(
            spark, source, shape, target, str(tmp_path / checkpoint),
            lambda pages: site_entries(pages, crawl=False, rules=["time_articles"]), "2026-01-01 00:00:00", max_files=1,
        ).awaitTermination()
        return sorted(r["title"] for r in store.read_entry_batches(spark, target).collect())

    snapshot("ab")
    assert run("one") == ["a", "b"]
    snapshot("bcc")
    assert run("one") == ["a", "b", "c"]
    assert run("one") == ["a", "b", "c"]  # nothing new to read
    assert run("two") == ["a", "b", "c"]  # everything read again, all of it known


@pytest.mark.parametrize("flags", [{"skip_selenium": True, "selenium_only": True}])
def test_both_type_switches_are_an_error(spark, flags):
    from feedloom.operators.registry import select_feeds
    from feedloom.plans.sites import site_registry

    with pytest.raises(ValueError):
        select_feeds(site_registry(spark), **flags)
