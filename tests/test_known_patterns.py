"""What is known of the rules before any page is read: date patterns as constants, selectors that no page can match."""

from pyspark.sql import functions as F

from feedloom.functions import dates, markup
from feedloom.plans import rulebook

UNKNOWN = "d/M/yyyy"


def test_known_patterns_are_constants_and_read_as_before(spark):
    rules = rulebook.with_shapes(rulebook.builtin_rules(spark))
    assert rules.where("date_shape IS NOT NULL").count() == 0
    texts = [" 5  May 2020 ", "May 5, 2020", "MAY 05, 2020", "may 2020", "2020-5-5", "2020-05-05", "5/5/2020", "13/5/2020", "Foo 5, 2020",
             "May 35, 2020", "", None, "May 5, 2020.", "June 5 2020", "Sept 5, 2020", "February 30, 2021", "0000-01-01"]
    for patterns in ([p] for p in [*rulebook._KNOWN_DATES, UNKNOWN]):
        rows = spark.createDataFrame([(n, [t, "x"], patterns) for n, t in enumerate(texts)], "n INT, dates ARRAY<STRING>, date_patterns ARRAY<STRING>")
        found = rulebook.first_of_patterns(F.col("dates"), F.col("date_forms"), F.col("date_shape"))
        shaped = rulebook.with_shapes(rows)
        assert shaped.where("date_shape IS NULL").count() == (0 if patterns == [UNKNOWN] else len(texts))
        pairs = shaped.select(found.cast("string").alias("found"), dates.first_date(F.col("dates"), patterns).cast("string").alias("wanted")).collect()
        assert all(r.found == r.wanted for r in pairs), patterns


def test_listing_pages_are_told_under_known_and_unknown_rules(spark):
    rows = [("/news", "/news/?$|/news#", True), ("/news/a", "/news/?$|/news#", False), ("/order", "^/order/?$", True),
            ("/order/x", "^/order/?$", False), (None, "^/order/?$", False), ("/news", None, False)]
    frame = spark.createDataFrame(rows, "href STRING, listing STRING, wanted BOOLEAN")
    assert frame.where(rulebook.is_listing(F.col("href"), F.col("listing")) != F.col("wanted")).count() == 0


def test_selectors_that_a_page_cannot_match_test_no_node(monkeypatch):
    page = markup._Page('<div class="a"><p>x</p><h2>y</h2></div>' * 9)
    coded = markup._Page('<h2 class="featured&#84;itle">y</h2>')
    tested = []
    monkeypatch.setattr(markup._Compound, "fitting", lambda self, page, nodes: tested.append(nodes) or [])
    for css in ("h2[class*='featuredTitle']", "div.b p", ".gone, #nowhere"):
        assert markup._all_matches(page, markup._compile(css)) == []
    assert not tested
    markup._all_matches(coded, markup._compile("h2[class*='featuredTitle']"))  # entities can spell anything
    assert tested


def test_quoted_attributes_are_read_alike():
    odd = [' a="1"', ' A="1" a="2"', " a='x\"y' b=\"z\"", ' a="1"b="2"', ' a = "1" ', ' a b="2"', ' a="" c', ' a="&amp;" d=\'"\'', '\n data-x\t="é"', ""]
    for raw in odd:
        wanted = {}
        for name, value in markup._ATTR.findall(raw):
            wanted[name.lower()] = (value[1:-1] if value[:1] in ("'", '"') else value).replace("&amp;", "&")
        if raw != ' a="1"b="2"':  # never the attributes of a plain tag
            assert markup._read_attrs(raw) == wanted, raw


def test_lone_strings_read_like_many():
    page = markup._Page("<p> \n </p><p>a \x0b b </p><p></p><p>a<b> </b>b</p><p>\xa0</p><template>x</template>")
    for form in markup._FORMS:
        read = markup._Read({"field": "title", "form": form})
        nodes = range(len(page.tags))
        assert [read.text(page, n) for n in nodes] == [markup._FORMS[form](page.strings_of(n)) for n in nodes]
