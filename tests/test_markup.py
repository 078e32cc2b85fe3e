"""The HTML walk and its selectors."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import markup


def nodes(spark, html, css):
    df = spark.range(1, numPartitions=1).select(F.lit(html).cast("string").alias("html"))
    found = df.select(F.inline(markup.select_nodes(F.col("html"), {"x": css})))
    return found.select(
        "pos",
        "parent_pos",
        "end_pos",
        "tag",
        "attrs",
        markup.node_text(F.struct("strings")).alias("text"),
        markup.tight_text(F.struct("strings")).alias("tight"),
        markup.spaced_text(F.struct("strings")).alias("spaced"),
    ).collect()


PAGE = """<html><body><div id="a" class="card big"><p>One<br>two</p><a href="/x/1">A</a></div>
<div class="card"><a href="https://h/x/2" data-k="v"><b>B</b> <i>C</i></a><a>none</a></div></body></html>"""


@pytest.mark.parametrize(
    ("css", "texts"),
    [
        ("a", ["A", "B C", "none"]),
        ("a[href]", ["A", "B C"]),
        ('a[href^="/x"]', ["A"]),
        ("a[href*='/x/']", ["A", "B C"]),
        ('[data-k="v"]', ["B C"]),
        ("#a a", ["A"]),
        ("div#a p", ["Onetwo"]),
        (".card.big a", ["A"]),
        ("div.card b, div.card i", ["B", "C"]),
        ("body .card a[href] i", ["C"]),
        ("p a", []),
        (".car", []),
    ],
)
def test_selectors(spark, css, texts):
    assert [n["text"] for n in nodes(spark, PAGE, css)] == texts


def test_text_readings(spark):
    (n,) = nodes(spark, "<a>\n One <b> two</b><br>three </a>", "a")
    assert (n["text"], n["tight"], n["spaced"]) == ("One  twothree", "Onetwothree", "One two three")


def test_unclosed_tags_stay_open_until_an_enclosing_end(spark):
    found = nodes(spark, "<div><p>one<p>two</div><p>three", "p")
    assert [n["text"] for n in found] == ["onetwo", "two", "three"]
    assert found[1]["parent_pos"] == found[0]["pos"]


def test_stray_end_tags_and_void_tags(spark):
    (n,) = nodes(spark, "</p><div>a<img src=x>b</span>c</div>d", "div")
    assert n["text"] == "abc" and n["end_pos"] == n["pos"] + 1


def test_scripts_are_opaque(spark):
    html = '<div>x<script>var t = "</p><a href=1>";</script><style>p{}</style>y<!-- c --></div>'
    assert [n["text"] for n in nodes(spark, html, "div")] == ["xy"]
    assert [n["text"] for n in nodes(spark, html, "script")] == ['var t = "</p><a href=1>";']
    assert nodes(spark, html, "a") == []


def test_entities_are_decoded_once(spark):
    (n,) = nodes(spark, '<a href="?a=1&amp;b=2">R&amp;amp;D &copy;</a>', "a")
    assert n["attrs"]["href"] == "?a=1&b=2" and n["text"] == "R&amp;D \xa9"


def test_empty_and_missing_pages(spark):
    assert nodes(spark, "", "a") == [] and nodes(spark, None, "a") == []


def test_many_unclosed_tags(spark):
    found = nodes(spark, "<b>" * 3000 + "x", "b")
    assert len(found) == 3000 and found[0]["end_pos"] == 2999
