"""Column functions on hand-made edge cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.functions import dates, text, urls


def value(spark, column, given=None):
    """What a column function makes of one text."""
    return spark.range(1).select(column(F.lit(given).cast("string")).alias("v")).first()["v"]


NEWS = ["MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy-M-d", "M/d/yyyy"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("Jan 5, 2026", datetime(2026, 1, 5)),
        ("january  05,\n2026", datetime(2026, 1, 5)),
        ("May 1 2024", datetime(2024, 5, 1)),
        ("2024-1-5", datetime(2024, 1, 5)),
        ("3/4/2024", datetime(2024, 3, 4)),
        ("Feb 30, 2024", None),
        ("January 5, 20266", None),
        ("January 005, 2026", None),
        ("Sept 5, 2026", None),
        ("on Jan 5, 2026", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, given, expected):
    assert value(spark, lambda t: dates.parse_date(t, NEWS), given) == expected


def test_month_only_is_first_of_month(spark):
    patterns = ["MMMM d, yyyy", "MMM d, yyyy", "MMMM yyyy", "MMM yyyy"]
    assert value(spark, lambda t: dates.parse_date(t, patterns), "Nov 2025") == datetime(2025, 11, 1)
    assert value(spark, lambda t: dates.parse_date(t, patterns), "November 2025") == datetime(2025, 11, 1)


def test_weekday_rules(spark):
    required = lambda t: dates.parse_date(dates.require_weekday(dates.strip_posted_on(t)), ["MMMM d, yyyy"])
    assert value(spark, required, "Posted on Sunday May 24, 2026") == datetime(2026, 5, 24)
    assert value(spark, required, "posted ON  Sunday May 24, 2026") == datetime(2026, 5, 24)
    assert value(spark, required, "May 24, 2026") is None
    with_comma = lambda t: dates.parse_date(dates.strip_weekday(t, comma=True), ["MMM d, yyyy"])
    assert value(spark, with_comma, "Tuesday, Jun 30, 2026") == datetime(2026, 6, 30)
    assert value(spark, with_comma, "Tuesday Jun 30, 2026") is None


def test_text_date_needs_a_real_day(spark):
    assert value(spark, dates.text_date, "by A. January 12,\n 2026 | 5 min") == datetime(2026, 1, 12)
    assert value(spark, dates.text_date, "June 31, 2026 and June 1, 2026") is None
    assert value(spark, dates.text_date, "Jan 12, 2026") is None


def test_fallback_is_stable_and_in_range(spark):
    df = spark.range(2000).select(dates.fallback_date(F.col("id").cast("string")).alias("d"))
    low, high, n = df.agg(F.min("d"), F.max("d"), F.countDistinct("d")).first()
    assert datetime(2023, 1, 1) <= low and high <= datetime(2024, 12, 30) and n > 600
    again = spark.range(2000).repartition(17).select(dates.fallback_date(F.col("id").cast("string")).alias("d"))
    assert again.exceptAll(df).isEmpty()


@pytest.mark.parametrize(
    ("given", "lenient", "strict"),
    [
        ("Tue, 02 Jan 2024 03:04:05 +0000", datetime(2024, 1, 2, 3, 4, 5), True),
        ("Tue, 02 Jan 2024 03:04:05 -0500", datetime(2024, 1, 2, 8, 4, 5), True),
        ("Tue, 02 Jan 2024 03:04:05 GMT", datetime(2024, 1, 2, 3, 4, 5), False),
        ("2 Jan 2024 03:04 EST", datetime(2024, 1, 2, 8, 4), False),
        ("2 Jan 2024 03:04:05", datetime(2024, 1, 2, 3, 4, 5), False),
        ("2 Jan 24 03:04:05 +0000", datetime(2024, 1, 2, 3, 4, 5), False),
        ("2 Jan 99 03:04:05 +0000", datetime(1999, 1, 2, 3, 4, 5), False),
        ("yesterday", None, False),
        ("", None, False),
    ],
)
def test_rfc822(spark, given, lenient, strict):
    assert value(spark, dates.parse_rfc822, given) == lenient
    assert value(spark, dates.parse_rfc822_strict, given) == (lenient if strict else None)


def test_whole_days_round_down(spark):
    def age(moment):
        return value(spark, lambda t: dates.whole_days(moment, t.cast("timestamp_ntz")), "2024-01-01 12:00:00")

    assert age("2024-03-01 11:59:59") == 59
    assert age("2024-03-01 12:00:00") == 60
    assert age("2024-01-01 11:00:00") == -1


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("2024-01-01", datetime(2024, 1, 1)),
        ("2024-01-01T05:00:00+02:00", datetime(2024, 1, 1, 3)),
        ("2024-01-01T05:00:00.250000+00:00", datetime(2024, 1, 1, 5, 0, 0, 250000)),
        ("2024-01-01 05:00:00", datetime(2024, 1, 1, 5)),
        ("2024", None),
        ("12:30", None),
        ("nope", None),
    ],
)
def test_iso_date(spark, given, expected):
    assert value(spark, dates.iso_date, given) == expected


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert value(spark, dates.parse_rfc822, "Tue, 02 Jan 2024 03:04:05 +0000") == datetime(2024, 1, 2, 3, 4, 5)
        assert value(spark, dates.iso_date, "2024-07-01T05:00:00+02:00") == datetime(2024, 7, 1, 3)
        assert value(spark, lambda t: dates.parse_date(t, NEWS), "Jan 5, 2026") == datetime(2026, 1, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_functions(spark):
    assert value(spark, text.sanitize_xml, "a\x00\x0b\x1f\x85b\t\r\n") == "ab\t\r\n"
    assert value(spark, text.strip, "　 a b\xa0\n") == "a b"
    assert value(spark, text.collapse_space, " a\xa0\n\x1c b ") == "a b"
    assert value(spark, text.escape_xml, "a & <b> &amp;") == "a &amp; &lt;b&gt; &amp;amp;"
    assert value(spark, text.unescape_common, "&amp;lt; &copy;") == "&lt; \xa9"
    assert value(spark, text.unescape_html, "&eacute;&amp;amp;&#x41;") == "\xe9&amp;A"
    assert value(spark, text.unescape_backslash, 'a \\"q\\" \\\\n') == 'a "q" \\n'
    assert value(spark, text.slug_title, "my-post-2b-it's") == "My Post 2B It'S"
    assert value(spark, text.url_category, "/research/news/x") == "News"


def test_chains(spark):
    words = lambda t: F.split(t, ",")
    assert value(spark, lambda t: text.first_match(words(t), 5), "abc,abcde,zzzzzz") == "abcde"
    assert value(spark, lambda t: text.first_match(words(t)), ",") is None
    assert value(spark, lambda t: text.first_category(words(t), "News"), "12 May,Mayor,Policy") == "Policy"
    assert value(spark, lambda t: text.first_category(words(t), "News"), "12 May,") == ""
    assert value(spark, lambda t: text.first_category(words(t), "News"), "12 May") == "News"
    assert value(spark, lambda t: text.first_paragraph(words(t), "equals"), ",Read More,Read more now") == "Read more now"
    assert value(spark, lambda t: text.first_paragraph(words(t), "prefix"), "READ more now,x") == "x"
    assert value(spark, lambda t: text.first_paragraph(words(t), None), ",Read more") == "Read more"
    assert value(spark, lambda t: text.description_or_title(t, F.lit("T")), "") == "T"


@pytest.mark.parametrize(
    ("mode", "given", "expected"),
    [
        ("prefix", "/a", "https://b.example/a"),
        ("prefix", "http://x/a", "http://x/a"),
        ("strip_slash", "//a", "https://b.example/a"),
        ("strip_slash", "a", "https://b.example/a"),
        ("rooted_or_bare", "a", "https://b.example/a"),
        ("rooted_or_bare", "/a", "https://b.example/a"),
        ("prefix_rooted", "a", "a"),
        ("https_or_rooted", "http://x/a", None),
        ("https_or_rooted", "https://x/a", "https://x/a"),
    ],
)
def test_absolute_url(spark, mode, given, expected):
    assert value(spark, lambda t: urls.absolute_url(t, "https://b.example", mode), given) == expected


def test_canonical_and_index(spark):
    assert value(spark, urls.canonical_url, "https://a/b//?x=/") == "https://a/b"
    for link, index in {"https://a/news": True, "https://a/news/": True, "https://a/news#x": True, "https://a/news/x": False}.items():
        assert value(spark, lambda t: urls.is_index_page(t, "news"), link) is index
