"""Site rules on hand-made pages: the cases the large generated pages do not hold."""

import pytest

from feedloom.functions.dates import fallback_date
from feedloom.plans.entries import extraction_quality, listing_candidates, site_entries
from feedloom.plans.sites import known_rules, site_channels, site_registry
from pyspark.sql import functions as F

PAGES = {
    "news_cards": """
      <a href="/news">index</a><a href="/news/"><h3>index page</h3></a>
      <a href="https://www.anthropic.com/news#team/news/"><h3>anchor link</h3></a>
      <a href=""><h3>empty</h3></a>
      <a href="/news/one"><b>broken first card</b></a><a href="/news/one"><h3>Hidden good card</h3></a>
      <a href="/news/two"><h2 class="a featuredTitle b">  </h2><span class="x-title">Span title</span><h3>Other</h3>
        <p class="detail-m">Policy</p><div class="my-date">nothing</div><div class="my-date">3/4/2024</div>
        <span class="text-label">Mar 2024</span></a>
      <a href="/news/three"><h3>abcd</h3></a>
      <a href="https://x.example/news/four"><h2>Four letters</h2><span class="caption bold"></span></a>""",
    "research_cards": """
      <div><p class="detail-m">Jan 1, 2020</p>
        <div><div><a href="/research/deep"><h3>abcd</h3> <h2>Far from the date</h2></a></div></div></div>
      <div><time>5 March 2021</time><div><a href="/research/near">Whole
          link text</a></div></div>
      <a href="/research">no slash</a><a href="http://x.example/research/a"><h3>not secure</h3></a>
      <a href="/research/tiny"><h3>abcd</h3></a>""",
    "note_links": """
      <a class="note" href="2025/x"><h3> </h3></a><a class="note" href="/2025/y/"><p>no heading</p></a>
      <a class="note" href="/2025/y/"><h3>hidden</h3></a>
      <a class="note" href="/2025/z/"><h3>Zed</h3><div class="description"></div></a>""",
    "dyn_items": """
      <div class="w-dyn-item"><a href="/blog/category/x"></a><h2>category</h2></div>
      <div class="w-dyn-item"><h2>no link</h2></div>
      <div class="w-dyn-item"><a href="/blog/p"></a><h3> </h3><h4>never reached</h4><p>June 1, 2025</p></div>
      <div class="w-dyn-item" data-category="Data"><a href="/blog/q"></a><h2>Q &amp;amp; A</h2><b>June 31, 2025</b></div>
      <div class="w-dyn-item"><a href="/blog/r"></a><h2>R</h2><p></p></div>
      <div class="w-dyn-item"><a href="/blog/q"></a><h2>Q dated</h2><b>June 1, 2025</b></div>""",
    "dated_articles": """
      <div id="content"><article><h1>no anchor</h1><h1><a href="/x">second heading</a></h1></article>
      <article><h1><a href="/2026-05-24_a">Slug date</a></h1><p class="date">Posted on May 1, 2020</p></article>
      <article><h1><a href="/b">Line</a></h1><p class="date">posted on Sunday May 24, 2026</p>
        <div class="summary"><p>read more</p><p>Body</p></div></article>
      <article><h1><a href="/b">Again</a></h1></article></div>""",
    "legacy_links": """<div class="blogentry"><a>no href</a></div><div class="blogentry x"><a href="g/1"> Old one </a></div>
      <div class="blogentry"><a href="/g/2"><img></a></div>""",
    "time_articles": """
      <article><h4>no heading</h4><a href="/blog/n">n</a></article>
      <article><h1>Top</h1><a href="/blog/t/?a#b">t</a><time>Tuesday Jun 30, 2026</time></article>
      <article><h2>Next</h2><a href="https://o.example/u//">u</a><time>June 30, 2026</time><p>Read more</p></article>""",
    "front_page": """
      <article class="mp-hero__lead"><h1 class="mp-hero__title"><a href="/a/">Lead</a></h1>
        <div class="mp-hero__byline"><span>July 15, 2026</span><span>8 min</span></div></article>
      <article class="mp-hero__lead"><h1 class="mp-hero__title"><a href="/second">Second lead</a></h1></article>
      <li class="mp-sidecar__item"><h3 class="mp-sidecar__title"><a href="/b">Side</a></h3><a class="mp-cat"> </a>
        <div class="mp-meta">July 1, 2026</div></li>
      <article class="mp-card"><h3 class="mp-card__title"><a href="/a">Card</a></h3></article>
      <article class="mp-card"><h3 class="mp-card__title"><a href="/c"></a></h3></article>""",
}

FALLBACK = "stand-in"
EXPECTED = {
    # link, title, description, category, date
    "news_cards": [
        ("https://www.anthropic.com/news/two", "Span title", "Span title", "Policy", "2024-03-04"),
        ("https://x.example/news/four", "Four letters", "Four letters", "", FALLBACK),
    ],
    "research_cards": [
        ("https://www.anthropic.com/research/deep", "Far from the date", "Far from the date", "Research", FALLBACK),
        ("https://www.anthropic.com/research/near", "Whole link text", "Whole link text", "Research", "2021-03-05"),
    ],
    "note_links": [
        ("https://red.anthropic.com/2025/x", "", "", None, FALLBACK),
        ("https://red.anthropic.com/2025/z/", "Zed", "", None, FALLBACK),
    ],
    "dyn_items": [
        ("https://claude.com/blog/q", "Q dated", "Q dated", None, "2025-06-01"),
        ("https://claude.com/blog/r", "R", "R", None, None),
    ],
    "dated_articles": [
        ("https://jamiehurst.co.uk/2026-05-24_a", "Slug date", "Slug date", None, "2026-05-24"),
        ("https://jamiehurst.co.uk/b", "Line", "Body", None, "2026-05-24"),
    ],
    "legacy_links": [("https://brettski.net/g/1", "Old one", "Old one", None, FALLBACK)],
    "time_articles": [
        ("https://o.example/u", "Next", "Next", None, "2026-06-30"),
        ("https://www.pulumi.com/blog/t", "Top", "Top", None, FALLBACK),
    ],
    "front_page": [
        ("https://itopfield.com.au/a", "Lead", "Lead", None, FALLBACK),
        ("https://itopfield.com.au/b", "Side", "Side", None, "2026-07-01"),
    ],
}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(rule, rule, html) for rule, html in PAGES.items()], "feed_name STRING, rule_id STRING, html STRING")


def test_every_rule(spark, pages):
    entries = site_entries(pages).withColumn(
        "day",
        F.when(F.col("published") == fallback_date(F.col("link")), FALLBACK).otherwise(F.date_format("published", "yyyy-MM-dd")),
    )
    found = {}
    for r in entries.orderBy("link").collect():
        found.setdefault(r["feed_name"], []).append((r["link"], r["title"], r["description"], r["category"], r["day"]))
    assert found == EXPECTED


def test_positions_follow_the_page(spark, pages):
    entries = site_entries(pages.where("rule_id = 'dyn_items'"), rules=["dyn_items"])
    order = [r["link"][-1] for r in entries.orderBy("seq").collect()]
    assert order == ["q", "r"]  # the dated copy stands where the first copy stood


def test_partitioning_does_not_matter(spark, pages):
    columns = ["feed_name", "link", "title", "description", "category", "published", "seq"]
    many = [tuple(map(str, r)) for r in site_entries(pages.repartition(17)).select(*columns).collect()]
    one = [tuple(map(str, r)) for r in site_entries(pages.coalesce(1)).select(*columns).collect()]
    assert sorted(many) == sorted(one)


def test_quality_counters(spark, pages):
    quality = extraction_quality(listing_candidates(pages.where("rule_id = 'news_cards'"), ["news_cards"])).first()
    # Seven anchors hold "/news/"; "one" and "three" have no usable structure.
    assert quality.asDict() == {"feed_name": "news_cards", "links_found": 7, "unknown_structures": 2, "valid_entries": 2}


def test_embedded_json(spark):
    q = '\\"'
    article = lambda day, slug, rest: f"{q}publishedOn{q}:{q}{day}{q},{q}slug{q}:{{{q}current{q}:{q}{slug}{q}}}{rest}"
    filler = " " * 2000
    script = "engineeringArticle" + filler.join(
        [
            article("2026-01-02", "my-post-2b", ""),
            article("2026-01-03", "quoted", f",{q}summary{q}:{q}a\\\\nb{q},{q}title{q}:{q}The \\\\{q}x\\\\{q}{q}"),
            article("2026-01-04", "quoted", f",{q}title{q}:{q}Never looked at{q}"),
            article("someday", "undated", f",{q}title{q}:{q}No date{q}"),
            article("2026-01-05", "tiny", f",{q}title{q}:{q}abc{q}"),
        ]
    )
    html = f"<script>publishedOn only</script><script>{script}</script><script>{article('2026-02-02', 'later', '')}engineeringArticle</script>"
    pages = spark.createDataFrame([("eng", "embedded_json", html), ("none", "embedded_json", "<p>x</p>")], "feed_name STRING, rule_id STRING, html STRING")
    found = [(r["link"].rsplit("/", 1)[1], r["title"], r["description"], str(r["published"])[:10]) for r in site_entries(pages).orderBy("seq").collect()]
    assert found == [
        ("my-post-2b", "My Post 2B", "My Post 2B", "2026-01-02"),
        ("quoted", 'The \\"x\\"', "a\\nb", "2026-01-03"),
        ("quoted", 'The \\"x\\"', "a\\nb", "2026-01-04"),
    ]


def test_known_sites(spark):
    registry, channels, rules = site_registry(spark), site_channels(spark), known_rules(spark)
    assert registry.count() == 9 and channels.count() == 9
    assert registry.join(channels, "feed_name").count() == 9
    assert registry.join(rules, "rule_id").count() == 9


def test_collections_of_one_site(spark):
    """Page 1 belongs to every collection; each collection is cut by itself."""

    def page(collection, number, links):
        html = "".join(f'<div class="w-dyn-item"><a href="/blog/{k}"></a><h2>{k}</h2></div>' for k in links)
        return ("site", "dyn_items", collection, number, html)

    pages = spark.createDataFrame(
        [
            page("", 1, "ab"),
            page("c1", 2, "ac"),
            page("c1", 3, "ab"),
            page("c1", 4, "bc"),
            page("c1", 5, "d"),  # after two pages without news
            page("c2", 2, "ce"),
            page("c2", 4, "f"),  # page 3 is missing
        ],
        "feed_name STRING, rule_id STRING, collection_id STRING, page_no INT, html STRING",
    )
    found = site_entries(pages, rules=["dyn_items"])
    assert [r["title"] for r in found.orderBy("title").collect()] == ["a", "b", "c", "e"]
    first_page = site_entries(pages, crawl=False, rules=["dyn_items"])
    assert [r["title"] for r in first_page.orderBy("seq").collect()] == ["a", "b"]


def test_rules_of_a_table_need_no_code(spark):
    from feedloom.plans import rulebook

    program = rulebook.program(
        [{"items": "div.x"}, {"items": "p", "fallback": True}],
        [
            {"field": "link", "path": ["a"], "attr": "href"},
            {"field": "link", "section": 1, "attr": "id"},
            {"field": "title", "path": ["b"], "min_chars": 3},
            {"field": "title", "form": "collapsed", "pattern": "named (\\w+)"},
            {"field": "date", "path": ["i"], "near": True},
        ],
    )
    row = ("mine", "https://m.example", "prefix", None, "^/all", 0, "first_dated", "non_blank", None, ["d.M.yyyy", "MMMM yyyy"], ["undated"], program, None)
    book = spark.createDataFrame([row, ("broken", *row[1:-2], None, None)], rulebook.RULE)
    html = (
        "<i>1.2.2020</i><div class=x><a href=/1>x</a><b>ab</b> named  \n one</div><section><i>9.11.2021</i>"
        "<div class=x><a href=/2></a><b>abc</b></div></section><div class=x><a href=/all></a><b>all of it</b></div>"
    )
    pages = spark.createDataFrame(
        [("f", "mine", html), ("g", "mine", "<p id=/p>named two <i>May 2020</i></p>"), ("h", "broken", html), ("k", "unknown", html), ("m", "mine", None)],
        "feed_name string, rule_id string, html string",
    )
    got = site_entries(pages, rulebook=book).collect()
    assert sorted((r.feed_name, r.link, r.title, str(r.published)) for r in got) == [
        ("f", "https://m.example/1", "one", "2020-02-01 00:00:00"),
        ("f", "https://m.example/2", "abc", "2021-11-09 00:00:00"),
        ("g", "https://m.example/p", "two", "2020-05-01 00:00:00"),
    ]


def test_shapes_of_patterns_that_are_data(spark):
    from feedloom.functions import dates
    from feedloom.plans.rules import DATE_PATTERNS

    patterns = sorted({p for known in DATE_PATTERNS.values() for p in known} | {"dd.MM.yyyy", "yyyy/M/d"})
    frame = spark.createDataFrame([(p,) for p in patterns], "p string")
    assert {r.p: r.s for r in frame.select("p", dates.shape_of(F.col("p")).alias("s")).collect()} == {p: dates._shape(p) for p in patterns}


def test_details_count_as_whole_rows(spark):
    from feedloom.plans.entries import with_details

    fields = "feed_name string, link string, rule_id string, options array<string>, date_patterns array<string>, detail string"
    from feedloom.plans import rulebook

    detail = rulebook.program([{"items": "div"}], [{"field": "date", "path": ["i"]}, {"field": "description", "path": ["p"]}])
    entries = spark.createDataFrame([("f", x, "r", [], ["yyyy-M-d"], detail) for x in "ab"], fields)
    bodies = [("f", "a", 2, "<div><i>2020-1-1</i><p>second</p></div>"), ("f", "a", 1, "<div><p>first</p></div>"), ("f", "c", 1, "<div></div>")]
    details = spark.createDataFrame(bodies, "feed_name string, link string, version int, html string")
    found = with_details(entries, details, ["version"])
    got = sorted((r.link, r.detail_date, r.detail_text) for r in found.collect())
    assert got == [("a", None, "first"), ("b", None, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    walked = plan[: plan.index("ArrowEvalPython")]
    assert "detail_html" not in "".join(line for line in walked.splitlines() if "Exchange" in line)
