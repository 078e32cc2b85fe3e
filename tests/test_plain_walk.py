"""Plain markup is read in one scan, with the nodes HTMLParser would give; dates are tried in the shapes of their rule."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import markup
from feedloom.plans import rulebook

PLAIN = [
    '<!doctype html><!-- c --><div id=content><h1><a href="/x?a=1&amp;b=2">R&amp;amp;D</a></h1><br/><p class=\'date\'> \n</p >x</div>',
    '<SCRIPT src=x>a</p>"<b></script ><style>p{}</style><template>t<a href=v>u</a></template><p/>tail &copy',
    "lead<b>one<b>two</i></b><img src=/u/>three<A HREF='a>b'>&#47;</A>",
]
ODD = ["a < b<p>c</p>", "<a href='x>y", "<!-- a -- b --><p>", "<?xml v?><p>x", "<textarea><p></textarea>", "</ p><1>", "<a/href=x>y</a b>"]


def dump(page):
    nodes = range(len(page.tags))
    return page.tags, [page.attrs(n) for n in nodes], page.parent, page.end, [page.strings_of(n) for n in nodes]


def parsed(text):
    """The page as HTMLParser alone reads it."""
    page = markup._Page("")
    markup._Parser(page, text)
    while page._open:
        page._close_top()
    return page


@pytest.mark.parametrize("text", PLAIN + ODD)
def test_one_scan_gives_the_nodes_of_the_parser(text):
    assert markup._Page("")._read_plain(text) == (text in PLAIN)
    assert dump(markup._Page(text)) == dump(parsed(text))


def test_known_attributes_are_bounded():
    compound = markup._Compound("a[href*='/x/']")
    page = markup._Page("".join(f'<a href="/x/{n}">' for n in range(3 * markup._MEMORY)))
    assert all(compound.fits(page, n) for n in range(len(page.tags))) and len(compound.known) <= markup._MEMORY


def test_shapes_are_worked_out_once_per_rule(spark):
    pages = spark.range(1).select(F.lit("f").alias("feed_name"), F.lit("news_cards").alias("rule_id"), F.lit("<p>").alias("html"))
    pages = pages.withColumns({"page_no": F.lit(1), "collection_id": F.lit("")}).repartition(2)
    rows = rulebook.read_listing(rulebook.with_rules(pages, rulebook.builtin_rules(spark)), ["feed_name", "page_no"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join")[0]
    assert "Join" in plan and "date_shape" in above and "<y4>" not in above  # a mark that shape_of leaves on its way


def test_first_text_that_fits_wins(spark):
    rules = spark.createDataFrame([(["MMM d, yyyy", "yyyy-M-d"],), ([],), (None,)], "date_patterns ARRAY<STRING>")
    texts = F.array(F.lit("soon"), F.lit(None), F.lit("2020-02-31"), F.lit(" 2020-03-04 "), F.lit("May 5, 2021"))
    found = rulebook.first_of_patterns(texts, F.col("date_forms"), F.col("date_shape")).cast("string")
    assert [r[0] for r in rulebook.with_shapes(rules).coalesce(1).select(found).collect()] == ["2020-03-04 00:00:00", None, None]
