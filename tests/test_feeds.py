"""Feed documents on disk: broken, empty, untouched and split ones; notices and retirement."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators import audit, lifecycle, render
from feedloom.operators.ordering import feed_order
from feedloom.plans.sites import site_channels
from feedloom.sources import feeds

ENTRY = "feed_name STRING, link STRING, title STRING, description STRING, category STRING, published TIMESTAMP_NTZ, seq BIGINT"


def entries(spark, feed, n, title="T"):
    data = [(feed, f"https://x/{i}", f"{title}{i}", "d", "C" if i % 2 else None, datetime(2026, 1, 1 + i % 27), i) for i in range(n)]
    return spark.createDataFrame(data, ENTRY)


def documents(spark, df, **options):
    return render.render_feeds(
        render.feed_items(feed_order(df)), site_channels(spark), "2026-08-22 18:09:33", "https://feeds.example.org", **options
    )


def test_document_layout(spark):
    data = [("pulumi", "https://x/?a&b", "A <b> & \x01c", "two\nlines", "Cat", datetime(2026, 8, 14), 1)]
    (row,) = documents(spark, spark.createDataFrame(data, ENTRY)).collect()
    assert row["part"] == 0
    assert row["rss_xml"].split("\n") == [
        "<?xml version='1.0' encoding='UTF-8'?>",
        '<rss xmlns:atom="http://www.w3.org/2005/Atom" xmlns:content="http://purl.org/rss/1.0/modules/content/" version="2.0">',
        "  <channel>",
        "    <title>Pulumi Blog</title>",
        "    <link>https://www.pulumi.com/blog/</link>",
        "    <description>Latest posts from the Pulumi Blog</description>",
        '    <atom:link href="https://feeds.example.org/feed_pulumi.xml" rel="self"/>',
        "    <docs>http://www.rssboard.org/rss-specification</docs>",
        "    <generator>feedloom</generator>",
        "    <language>en</language>",
        "    <lastBuildDate>Sat, 22 Aug 2026 18:09:33 +0000</lastBuildDate>",
        "    <item>",
        "      <title>A &lt;b&gt; &amp; c</title>",
        "      <link>https://x/?a&amp;b</link>",
        "      <description>two",
        "lines</description>",
        '      <guid isPermaLink="false">https://x/?a&amp;b</guid>',
        "      <category>Cat</category>",
        "      <pubDate>Fri, 14 Aug 2026 00:00:00 +0000</pubDate>",
        "    </item>",
        "  </channel>",
        "</rss>",
    ]


def test_split_documents_come_back_whole(spark, tmp_path):
    path = str(tmp_path / "feeds")
    df = entries(spark, "a/b c+d", 25)
    feeds.write_feeds(documents(spark, df, items_per_document=10), path)
    parsed = feeds.read_feeds(spark, path)
    assert parsed.count() == 3 and not parsed.where("broken").count()
    back = feeds.feed_items(parsed)
    wanted = feed_order(df).select("feed_name", "feed_pos", "title", "link", "category", "published")
    assert back.select(wanted.columns).exceptAll(wanted).isEmpty() and back.count() == 25


def test_parts_are_linked_pages(spark):
    def links(xml):
        return re.findall(r'<atom:link href="([^"]*)" rel="(\w+)"/>', xml)

    both = entries(spark, "blog", 25).unionByName(entries(spark, "blog.2", 20))
    made = documents(spark, both, items_per_document=10)
    found = {(r["feed_name"], r["part"]): links(r["rss_xml"]) for r in made.collect()}
    base = "https://feeds.example.org/feed_blog"
    assert found == {
        ("blog", 0): [(f"{base}.xml", "self"), (f"{base}/1.xml", "next")],
        ("blog", 1): [(f"{base}/1.xml", "self"), (f"{base}.xml", "previous"), (f"{base}/2.xml", "next")],
        ("blog", 2): [(f"{base}/2.xml", "self"), (f"{base}/1.xml", "previous")],
        ("blog.2", 0): [(f"{base}.2.xml", "self"), (f"{base}.2/1.xml", "next")],
        ("blog.2", 1): [(f"{base}.2/1.xml", "self"), (f"{base}.2.xml", "previous")],
    }
    back = feeds.feed_items(feeds.parse_feeds(made.withColumnRenamed("rss_xml", "xml")))
    wanted = feed_order(both).select("feed_name", "feed_pos", "link")
    assert back.select(wanted.columns).exceptAll(wanted).isEmpty() and back.count() == 45


def test_feeds_without_documents_are_not_touched(spark, tmp_path):
    path = str(tmp_path / "feeds")
    feeds.write_feeds(documents(spark, entries(spark, "one", 3).unionByName(entries(spark, "two", 30)), items_per_document=10), path)
    feeds.write_feeds(documents(spark, entries(spark, "two", 2, "New"), items_per_document=10), path)
    feeds.write_feeds(documents(spark, entries(spark, "one", 0)), path)
    titles = feeds.feed_items(feeds.read_feeds(spark, path)).groupBy("feed_name").agg(F.sort_array(F.collect_list("title")).alias("t"))
    assert {r["feed_name"]: r["t"] for r in titles.collect()} == {"one": ["T0", "T1", "T2"], "two": ["New0", "New1"]}


@pytest.fixture
def folder(tmp_path):
    def item(day):
        return f"<item><title>t</title><link> https://x/{day} </link><pubDate>{day}</pubDate></item>"

    files = {
        "fresh": f"<rss><channel><title>t</title>{item('Wed, 01 Jul 2026 00:00:00 GMT')}{item('bad')}</channel></rss>",
        "edge": f"<rss><channel>{item('Tue, 30 Jun 2026 01:00:00 +0000')}</channel></rss>",
        "stale": f"<rss><channel>{item('Mon, 29 Jun 2026 00:00:00 +0000')}</channel></rss>",
        "undated": f"<rss><channel>{item('never')}</channel></rss>",
        "empty": "<rss><channel><title>t</title></channel></rss>",
        "other": "<html><body/></html>",
        "broken": "<rss><channel><item>",
        "zero": "",
    }
    for name, xml in files.items():
        (tmp_path / f"feed_{name}.xml").write_text(xml)
    (tmp_path / "notes.txt").write_text("not a feed")
    return str(tmp_path)


def test_audit_of_a_folder(spark, folder):
    parsed = feeds.read_feeds(spark, folder, "feed_*.xml")
    expected = spark.createDataFrame([(n,) for n in ("fresh", "zero", "missing")], "feed_name STRING")
    states = feeds.feed_states(parsed, expected)
    report = audit.audit_feeds(feeds.feed_items(parsed), states, "2026-08-30 00:00:00")
    found = {r["feed_name"]: (r["status"], r["message"]) for r in report.collect()}
    assert found == {
        "fresh": ("OK", "2 items, newest: 2026-07-01"),
        "edge": ("OK", "1 items, newest: 2026-06-30"),
        "stale": ("STALE", "1 items, newest: 2026-06-29 (62 days ago)"),
        "undated": ("OK", "1 items, no parseable dates"),
        "empty": ("EMPTY", "0 items"),
        "other": ("EMPTY", "0 items"),
        "broken": ("ERROR", "XML parse error"),
        "zero": ("ERROR", "XML parse error"),
        "missing": ("ERROR", "XML parse error"),
    }
    assert audit.audit_failed(report).first()["failed"]
    links = feeds.feed_links(feeds.feed_items(parsed))
    assert links.where("link <> trim(link)").isEmpty() and links.where("feed_name = 'fresh'").count() == 2


def test_notice_layout_and_order(spark):
    items = render.feed_items(feed_order(entries(spark, "a", 2)))
    notices = spark.createDataFrame([("a", "Moved.", "https://new"), ("gone", "x", None)], "feed_name STRING, message STRING, alternative_url STRING")
    known = spark.createDataFrame([("a",)], "feed_name STRING")
    with_notice = lifecycle.inject_notices(items, notices, known, "2026-05-01 00:00:00")
    assert with_notice.count() == 3
    rejected = lifecycle.checked_notices(notices, known).where("NOT known")
    assert [r["feed_name"] for r in rejected.collect()] == ["gone"]
    first = render.render_items(with_notice).orderBy("feed_pos").first()["item_xml"]
    assert [line.strip().split(">")[0] for line in first.split("\n") if line.startswith("      <")] == [
        "<title", "<description", '<guid isPermaLink="false"', "<pubDate", "<link",
    ]
    again = lifecycle.inject_notices(with_notice, notices, known, "2026-06-01 00:00:00")
    assert again.exceptAll(with_notice).isEmpty() and again.count() == 3


def test_retirement_is_strictly_after_the_waiting_time(spark):
    guid = lifecycle.NOTICE_PREFIX
    data = [
        ("day90", 1, guid + "day90", datetime(2026, 1, 1)),
        ("older", 1, guid + "older", datetime(2025, 12, 31, 23, 59, 59)),
        ("second", 1, guid + "second", None),
        ("second", 2, guid + "second", datetime(2025, 1, 1)),
        ("second", 3, guid + "second", datetime(2026, 3, 30)),
        ("none", 1, "https://x", datetime(2020, 1, 1)),
    ]
    items = spark.createDataFrame(data, "feed_name STRING, feed_pos BIGINT, guid STRING, published TIMESTAMP_NTZ")
    going = lifecycle.retire_feeds(items, "2026-04-01 00:00:00")
    assert {r["feed_name"]: r["age_days"] for r in going.collect()} == {"older": 90, "second": 455}
    left = lifecycle.retire_feeds(items, "2026-04-01 00:00:00", apply=True)
    assert sorted(r["feed_name"] for r in left.collect()) == ["day90", "none"]
