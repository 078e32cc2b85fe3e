"""Queries for the site rules: orders written as listing pages and extracted again.

Twenty orders make one page of one site, so pages stay small however large the table is.
The SQL states what the rule must find, straight from the orders.
"""

from pyspark.sql import functions as F

from feedloom.catalog.base import ORACLES, query, spread, sql_fallback, sql_stamp, stamp, table
from feedloom.plans import entries as plans

SITE = "'site-' || o_orderkey // 20"
TITLE = "'Order ' || o_orderkey || ' ' || o_orderpriority"
DAY = "date_trunc('day', o_orderdate)"


def _key():
    return F.col("o_orderkey")


def _key_text():
    return _key().cast("string")


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _written(form):
    return F.date_format("o_orderdate", form)


def _site():
    return _text("site-", F.floor(_key() / 20).cast("string"))


def _title():
    return _text("Order ", _key_text(), " ", F.col("o_orderpriority"))


def _same_link():
    """Every tenth order repeats the link of the one before it."""
    key = _key()
    return F.when(key % 10 == 9, key - 1).otherwise(key).cast("string")


def _pages(spark, sf_dir, rule, item, before="", after=""):
    """Pages of twenty orders. Orders are spread as they are and written where they lie: their markup is many times as large."""
    orders = table(spark, sf_dir, "orders").withColumn("feed_name", _site())
    return (
        spread(orders, "feed_name")
        .select("feed_name", "o_orderkey", item.alias("item"))
        .groupBy("feed_name")
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "item"))).alias("found"))
        .select(
            "feed_name",
            F.lit(rule).alias("rule_id"),
            _text(before, F.array_join(F.transform("found", lambda x: x["item"]), ""), after).alias("html"),
        )
    )


def _shown(rows, *columns):
    return rows.select("feed_name", "link", "title", *columns, stamp("published"))


NEWS_OK = "o_orderkey % 10 <> 9 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0"


def _news_pages(spark, sf_dir):
    heading = (
        F.when(_key() % 17 == 0, "<b>no heading</b>")
        .when(_key() % 19 == 0, "<h3>abc</h3>")
        .when(_key() % 2 == 0, _text('<h2 class="x featuredTitle-1"> </h2><h4 class="title">', _title(), "</h4>"))
        .otherwise(_text("<h3>\n ", _title(), " </h3>"))
    )
    forms = ["MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "yyyy-MM-dd", "MM/dd/yyyy"]
    day = F.lit("soon")
    for number, form in enumerate(forms):
        day = F.when(_key() % 6 == number, _written(form)).otherwise(day)
    topic = F.when(_key() % 3 == 0, "May report").otherwise(F.col("o_orderpriority"))
    item = _text(
        '<li><a href="/news/order-', _same_link(), '">', heading,
        "<time>later</time><p class='detail-m'>", day, '</p><span class="subject-2">', topic, "</span></a>",
    )
    return _pages(spark, sf_dir, "news_cards", item, '<a href="/news/">All</a><a href="/news#x">x</a><ul>')


@query(f"""
WITH o AS (SELECT *, 'https://www.anthropic.com/news/order-' || o_orderkey AS link FROM orders WHERE {NEWS_OK})
SELECT {SITE} AS feed_name, link, {TITLE} AS title, {TITLE} AS description,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority WHEN o_orderkey % 6 = 5 THEN 'soon' ELSE
         CASE WHEN o_orderkey % 6 = 3 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'News' END END AS category,
       {sql_stamp(f"CASE WHEN o_orderkey % 6 = 5 THEN {sql_fallback('link')} ELSE {DAY} END")} AS published
FROM o""")
def site_news_cards(spark, sf_dir):
    return _shown(plans.site_entries(_news_pages(spark, sf_dir), rules=["news_cards"]), "description", "category")


@query(f"""
SELECT {SITE} AS feed_name, count(*) + 1 AS links_found,
       count(*) FILTER (WHERE o_orderkey % 10 <> 9 AND (o_orderkey % 17 = 0 OR o_orderkey % 19 = 0)) AS unknown_structures,
       count(*) FILTER (WHERE {NEWS_OK}) AS valid_entries
FROM orders GROUP BY 1""")
def extraction_quality(spark, sf_dir):
    return plans.extraction_quality(plans.listing_candidates(_news_pages(spark, sf_dir), ["news_cards"])).select(
        "feed_name", "links_found", "unknown_structures", "valid_entries"
    )


def _research_cards_pages(spark, sf_dir):
    day = _written("d MMM yyyy")
    stamped = _text('<p class="detail-m">', day, "</p>")
    href = (
        F.when(_key() % 11 == 0, _text("http://other.example/research/order-", _key_text()))
        .when(_key() % 7 == 0, _text("https://other.example/research/order-", _key_text()))
        .otherwise(_text("/research/", F.when(_key() % 5 == 0, "news/").otherwise(""), "order-", _key_text()))
    )
    label = F.when(_key() % 3 == 0, _text("<i>Plain</i> \n link <u>", _key_text(), "</u>")).otherwise(
        _text("<h3>abc</h3><h2> ", _title(), "</h2>")
    )
    # The date may stand in the card, beside it, or one level further out; a far date must not count.
    own = F.when((_key() % 4 == 0) & (_key() % 3 != 0), stamped).otherwise("")
    beside = F.when((_key() % 4 == 1) | ((_key() % 4 == 0) & (_key() % 3 == 0)), stamped).otherwise("")
    outer = F.when(_key() % 4 == 2, stamped).otherwise("")
    item = _text(
        "<section>", outer, "<div>", beside, '<a href="', href, '">', label, own, "</a></div></section>",
    )
    far = '<p class="detail-m">Jan 1, 1990</p><a href="/research/">x</a>'
    return _pages(spark, sf_dir, "research_cards", item, far)


@query(f"""
WITH o AS (
  SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 'https://other.example/research/order-'
                 ELSE 'https://www.anthropic.com/research/' || CASE WHEN o_orderkey % 5 = 0 THEN 'news/' ELSE '' END || 'order-' END
            || o_orderkey AS link
  FROM orders WHERE o_orderkey % 11 <> 0)
SELECT {SITE} AS feed_name, link,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Plain link ' || o_orderkey ELSE {TITLE} END AS title,
       CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0 THEN 'News' ELSE 'Research' END AS category,
       {sql_stamp(f"CASE WHEN o_orderkey % 4 = 3 THEN {sql_fallback('link')} ELSE {DAY} END")} AS published
FROM o""")
def site_research_cards(spark, sf_dir):
    rows = plans.site_entries(_research_cards_pages(spark, sf_dir), rules=["research_cards"])
    return _shown(rows, "category")


def _note_links_pages(spark, sf_dir):
    href = (
        F.when(_key() % 3 == 0, _text("/notes/", _key_text())).when(_key() % 3 == 1, _key_text()).otherwise(_text("https://else.example/", _key_text()))
    )
    heading = F.when(_key() % 13 == 0, "").otherwise(_text("<h3>", _title(), "</h3>"))
    about = F.when(_key() % 5 == 0, "").otherwise(
        _text('<div class="description">About ', F.col("o_orderstatus"), "</div>")
    )
    item = _text('<a class="big note" href="', href, '">', heading, about, "</a>")
    return _pages(spark, sf_dir, "note_links", item, '<div class="date">May 2020</div>')


def _note_links_details(spark, sf_dir):
    link = (
        F.when(_key() % 3 == 0, _text("https://red.anthropic.com/notes/", _key_text()))
        .when(_key() % 3 == 1, _text("https://red.anthropic.com/", _key_text()))
        .otherwise(_text("https://else.example/", _key_text()))
    )
    day = (
        F.when(_key() % 7 == 1, "some day").when(_key() % 7 == 2, _written("MMMM yyyy")).otherwise(_written("MMMM d, yyyy"))
    )
    return table(spark, sf_dir, "orders").where(_key() % 7 != 0).select(
        _site().alias("feed_name"),
        link.alias("link"),
        _text("<p>March 3, 1970</p><d-article><p> ", day, " </p><p>May 5, 1975</p></d-article>").alias("html"),
    )


@query(f"""
WITH o AS (
  SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'https://red.anthropic.com/notes/' WHEN 1 THEN 'https://red.anthropic.com/'
                 ELSE 'https://else.example/' END || o_orderkey AS link
  FROM orders WHERE o_orderkey % 13 <> 0)
SELECT {SITE} AS feed_name, link, {TITLE} AS title,
       CASE WHEN o_orderkey % 5 = 0 THEN {TITLE} ELSE 'About ' || o_orderstatus END AS description,
       {sql_stamp(f'''CASE WHEN o_orderkey % 7 IN (0, 1) THEN {sql_fallback('link')}
                      WHEN o_orderkey % 7 = 2 THEN date_trunc('month', o_orderdate) ELSE {DAY} END''')} AS published
FROM o""")
def site_note_links(spark, sf_dir):
    pages, details = _note_links_pages(spark, sf_dir), _note_links_details(spark, sf_dir)
    return _shown(plans.site_entries(pages, details=details, rules=["note_links"]), "description")


def _dyn_items_pages(spark, sf_dir):
    heading = (
        F.when(_key() % 3 == 0, _text("<h2>", _title(), "</h2>"))
        .when(_key() % 3 == 1, _text('<h2> </h2>'))
        .otherwise(_text('<h4><b>', _title(), "</b></h4><h2></h2>"))
    )
    copy = F.when(_key() % 3 == 1, _text(' data-cta-copy="', _title(), '"')).otherwise("")
    day = F.when(_key() % 4 != 0, _written("MMMM d, yyyy")).otherwise("undated")
    topic = F.when(_key() % 2 == 0, _text('<i fs-list-field="category"> ', F.col("o_orderpriority"), "</i>")).otherwise("")
    data = F.when(_key() % 5 != 0, _text(' data-category="', F.col("o_orderstatus"), '"')).otherwise("")
    about = F.when(_key() % 3 == 0, "").otherwise(_text("<p>R&amp;amp;D &amp;lt;", _key_text(), "&amp;gt;</p>"))
    folder = F.when(_key() % 11 == 0, "/blog/category/").otherwise("/blog/")
    item = _text(
        '<div class="w-dyn-item x"', data, '><a href="', folder, "order-", _same_link(), '"', copy, "></a>",
        heading, "<span>by A on ", day, ".</span>", topic, about, "</div>",
    )
    return _pages(spark, sf_dir, "dyn_items", item)


@query(f"""
WITH o AS (
  SELECT *, CASE WHEN o_orderkey % 10 = 9 THEN o_orderkey - 1 ELSE o_orderkey END AS owner,
         CASE WHEN o_orderkey % 4 <> 0 THEN {DAY} END AS day
  FROM orders WHERE o_orderkey % 11 <> 0),
w AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY owner ORDER BY day IS NULL, o_orderkey) = 1)
SELECT {SITE} AS feed_name, 'https://claude.com/blog/order-' || owner AS link, {TITLE} AS title,
       CASE WHEN o_orderkey % 3 = 0 THEN {TITLE} ELSE 'R&D <' || o_orderkey || '>' END AS description,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS category,
       {sql_stamp("day")} AS published
FROM w""")
def site_dyn_items(spark, sf_dir):
    rows = plans.site_entries(_dyn_items_pages(spark, sf_dir), rules=["dyn_items"])
    return _shown(rows, "description", "category")


def _dated_articles_pages(spark, sf_dir):
    prefix = F.when(_key() % 3 == 1, _text(_written("yyyy-MM-dd"), "_")).otherwise("")
    day = (
        F.when(_key() % 3 == 0, _text("Posted on ", _written("EEEE MMMM d, yyyy")))
        .when(_key() % 3 == 1, "")
        .otherwise(_written("MMMM d, yyyy"))  # no weekday: this site's list refuses it
    )
    title = F.when(_key() % 13 == 0, " ").otherwise(_text(_title(), " &amp;amp; more"))
    about = F.when(_key() % 4 == 0, "<p>READ MORE</p>").otherwise(
        _text("<p> </p><p>Read More</p><p>Some <b>bold</b>\n", F.col("o_orderstatus"), " &amp;nbsp; text</p><p>x</p>")
    )
    item = _text(
        '<article><h1><a href="/', prefix, "order-", _key_text(), '"><b>', title, '</b></a></h1><p class="date">', day,
        '</p><div class="summary">', about, "</div></article>",
    )
    outside = '<article><h1><a href="/out">outside</a></h1></article>'
    return _pages(spark, sf_dir, "dated_articles", item, f'{outside}<div id="content">', "</div>")


@query(f"""
WITH o AS (
  SELECT *, 'https://jamiehurst.co.uk/' || CASE WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') || '_' ELSE '' END
         || 'order-' || o_orderkey AS link
  FROM orders WHERE o_orderkey % 13 <> 0)
SELECT {SITE} AS feed_name, link, {TITLE} || ' & more' AS title,
       CASE WHEN o_orderkey % 4 = 0 THEN {TITLE} || ' & more' ELSE 'Some bold ' || o_orderstatus || ' text' END AS description,
       {sql_stamp(f"CASE WHEN o_orderkey % 3 = 2 THEN {sql_fallback('link')} ELSE {DAY} END")} AS published
FROM o""")
def site_dated_articles(spark, sf_dir):
    rows = plans.site_entries(_dated_articles_pages(spark, sf_dir), rules=["dated_articles"])
    return _shown(rows, "description")


def _listing_bodies(spark, sf_dir):
    day = F.when(_key() % 5 == 0, "no day").otherwise(_written("yyyy-MM-dd"))
    row = F.struct(
        day.alias("date"),
        F.when(_key() % 11 != 0, _text("posts/", _key_text())).alias("s3Key"),
        F.when(_key() % 7 == 0, " ").otherwise(_text(_title(), " &amp; more")).alias("title"),
    )
    orders = table(spark, sf_dir, "orders").withColumn("feed_name", _site())
    return (
        spread(orders, "feed_name")
        .select("feed_name", "o_orderkey", row.alias("r"))
        .groupBy("feed_name")
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "r"))).alias("found"))
        .select("feed_name", F.to_json(F.transform("found", lambda x: x["r"])).alias("body"))
    )


LISTED = f"""
recent AS (
  SELECT *, 'https://brettski.net/posts/' || o_orderkey AS link, {TITLE} || ' & more' AS title
  FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0),
legacy AS (
  SELECT *, 'https://brettski.net/' || CASE WHEN o_orderkey % 2 = 0 THEN 'posts/' ELSE 'old/' END || o_orderkey AS link,
         'Old <' || o_orderkey || '>' AS title
  FROM orders WHERE o_orderkey % 3 <> 0),
listed AS (
  SELECT {SITE} AS feed_name, link, title, o_orderkey, o_orderstatus,
         CASE WHEN o_orderkey % 5 = 0 THEN {sql_fallback("link")} ELSE {DAY} END AS published
  FROM recent
  UNION ALL
  SELECT {SITE}, link, title, o_orderkey, o_orderstatus, {sql_fallback("link")}
  FROM legacy WHERE link NOT IN (SELECT link FROM recent))
"""


def _legacy_pages(spark, sf_dir):
    folder = F.when(_key() % 2 == 0, "/posts/").otherwise("old/")
    anchor = F.when(_key() % 3 == 0, "no anchor").otherwise(
        _text('<a href="', folder, _key_text(), '">Old &amp;lt;', _key_text(), "&amp;gt;</a>")
    )
    return _pages(spark, sf_dir, "legacy_links", _text('<div class="blogentry">', anchor, "</div>"))


@query(f"""
WITH {LISTED}
SELECT feed_name, link, title,
       CASE WHEN o_orderkey % 4 = 0 THEN title
            WHEN o_orderkey % 4 = 1 THEN 'First ' || o_orderstatus ELSE 'Inside ' || o_orderkey END AS description,
       {sql_stamp("published")} AS published
FROM listed""")
def site_json_and_legacy(spark, sf_dir):
    """Two sources of one site: a JSON listing, then the old links of its page; details from their own pages."""
    inside = F.when(
        _key() % 4 == 1, _text("<p>\n</p><p>First <b>", F.col("o_orderstatus"), "</b></p><p>second</p>")
    ).otherwise(
        _text('<p>outside</p><div id="blogcontent"><p></p><p>Inside&nbsp;', _key_text(), "</p></div>")
    )
    orders = table(spark, sf_dir, "orders").where(_key() % 4 != 0)
    both = F.explode(F.array(F.lit("posts/"), F.lit("old/")))
    details = orders.select("*", both.alias("folder")).select(
        _site().alias("feed_name"),
        _text("https://brettski.net/", F.col("folder"), _key_text()).alias("link"),
        inside.alias("html"),
    )
    rows = plans.site_entries(_legacy_pages(spark, sf_dir), _listing_bodies(spark, sf_dir), details, rules=["legacy_links"])
    return _shown(rows, "description")


@query(f"""
WITH {LISTED}
SELECT feed_name, link, title, {sql_stamp("published")} AS published
FROM listed WHERE o_orderkey % 6 <> 4""")
def site_new_only(spark, sf_dir):
    """Links the store knows are left out before the detail pages are read."""
    known = table(spark, sf_dir, "orders").where(_key() % 6 == 4)
    both = F.explode(F.array(F.lit("posts/"), F.lit("old/")))
    stored = known.select("*", both.alias("folder")).select(
        _site().alias("feed_name"),
        _text("https://brettski.net/", F.col("folder"), _key_text()).alias("link"),
        F.lit(0).cast("bigint").alias("seq"),
    )
    rows = plans.site_entries(_legacy_pages(spark, sf_dir), _listing_bodies(spark, sf_dir), stored=stored, rules=["legacy_links"])
    return _shown(rows)


def _time_articles_pages(spark, sf_dir):
    forms = ["EEEE, MMM d, yyyy", "EEEE, MMMM d, yyyy", "MMM d, yyyy", "MMMM d, yyyy", "EEEE, MMM d, yyyy"]
    day = F.lit("")
    for number, form in enumerate(forms):
        day = F.when(_key() % 6 == number, _text("<time> ", _written(form), "</time>")).otherwise(day)
    ending = F.when(_key() % 3 == 0, "?utm=1").when(_key() % 3 == 1, "/").otherwise("//?a=/b/")
    heading = F.when(_key() % 13 == 0, "").otherwise(_text("<h3>", _title(), "</h3>"))
    about = F.when(_key() % 4 == 0, "<p>read more here</p>").otherwise(
        _text("<p>Read more &gt;</p><p>Text of\n <b>", _key_text(), "</b></p>")
    )
    item = _text(
        "<article>", heading, '<a href="/blog/order-', _same_link(), ending, '">go</a>', day, about, "</article>",
    )
    return _pages(spark, sf_dir, "time_articles", item)


@query(f"""
WITH o AS (
  SELECT *, 'https://www.pulumi.com/blog/order-' || o_orderkey AS link FROM orders
  WHERE o_orderkey % 10 <> 9 AND o_orderkey % 13 <> 0
  UNION ALL
  -- The one before it was refused, so the copy of its link counts.
  SELECT *, 'https://www.pulumi.com/blog/order-' || (o_orderkey - 1) FROM orders
  WHERE o_orderkey % 10 = 9 AND (o_orderkey - 1) % 13 = 0 AND o_orderkey % 13 <> 0)
SELECT {SITE} AS feed_name, link, {TITLE} AS title,
       CASE WHEN o_orderkey % 4 = 0 THEN {TITLE} ELSE 'Text of ' || o_orderkey END AS description,
       {sql_stamp(f"CASE WHEN o_orderkey % 6 = 5 THEN {sql_fallback('link')} ELSE {DAY} END")} AS published
FROM o""")
def site_time_articles(spark, sf_dir):
    rows = plans.site_entries(_time_articles_pages(spark, sf_dir), rules=["time_articles"])
    return _shown(rows, "description")


def _front_page_pages(spark, sf_dir):
    day = F.when(_key() % 7 == 0, "recently").otherwise(_written("MMMM d, yyyy"))
    topic = F.when(_key() % 4 != 0, _text('<a class="mp-cat">', F.col("o_orderpriority"), "</a>")).otherwise("")
    card = _text(
        '<article class="mp-card"><h3 class="mp-card__title"><a href="/order-', _key_text(), '/">Card ', _key_text(), "</a></h3>", topic,
        '<div class="mp-meta">March 3, 1970</div><div class="mp-meta mp-meta--mt">', day, "</div></article>",
    )
    side = _text(
        '<li class="mp-sidecar__item"><h3 class="mp-sidecar__title"><a href="/order-', _key_text(), '">Side ', _key_text(), "</a></h3>",
        topic, '<div class="mp-meta">', day, "</div></li>",
    )
    hero = _text(
        '<article class="mp-hero__lead"><h1 class="mp-hero__title"><a href="/order-', _key_text(), '">Hero ', _key_text(), "</a></h1>",
        topic, '<div class="mp-hero__byline"><span>By X</span><span>', day, "</span></div></article>",
    )
    place = _key() % 20
    item = _text(card, F.when((place > 0) & (place <= 5), side).when(place == 0, hero).otherwise(""))
    return _pages(spark, sf_dir, "front_page", item)


def _front_page_details(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(_key() % 3 != 0).select(
        _site().alias("feed_name"),
        _text("https://itopfield.com.au/order-", _key_text()).alias("link"),
        _text('<head><meta name="author" content="z"><meta name="description" content=" A &amp;amp;\n B &quot;', _key_text(),
              '&quot; "></head><body><p>x</p></body>').alias("html"),
    )


@query(f"""
WITH o AS (
  SELECT *, CASE WHEN o_orderkey % 20 = 0 THEN 'Hero ' WHEN o_orderkey % 20 <= 5 THEN 'Side ' ELSE 'Card ' END AS part,
         'https://itopfield.com.au/order-' || o_orderkey AS link
  FROM orders)
SELECT {SITE} AS feed_name, link, part || o_orderkey AS title,
       CASE WHEN o_orderkey % 3 = 0 THEN part || o_orderkey ELSE 'A & B "' || o_orderkey || '"' END AS description,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS category,
       {sql_stamp(f"CASE WHEN o_orderkey % 7 = 0 THEN {sql_fallback('link')} ELSE {DAY} END")} AS published
FROM o""")
def site_front_page(spark, sf_dir):
    """The same link in three sections: hero before sidecar before cards."""
    pages, details = _front_page_pages(spark, sf_dir), _front_page_details(spark, sf_dir)
    return _shown(plans.site_entries(pages, details=details, rules=["front_page"]), "description", "category")


WALKED = {
    "news_cards": _news_pages,
    "research_cards": _research_cards_pages,
    "note_links": _note_links_pages,
    "dyn_items": _dyn_items_pages,
    "dated_articles": _dated_articles_pages,
    "time_articles": _time_articles_pages,
    "front_page": _front_page_pages,
}


def _named(df, rule):
    # A name that cannot be NULL: no rule gets a filter of its own below its shuffle of orders, so the rules share shuffles.
    return df.withColumn("feed_name", F.format_string(f"{rule}:%s", "feed_name"))


@query(
    " UNION ALL ".join(
        f"SELECT '{rule}:' || feed_name AS feed_name, link, title, description, published FROM ({sql})"
        for rule, sql in (
            ("news_cards", ORACLES["site_news_cards"]),
            ("research_cards", ORACLES["site_research_cards"].replace("AS title,", "AS title, NULL AS description,", 1)),
            ("note_links", ORACLES["site_note_links"]),
            ("dyn_items", ORACLES["site_dyn_items"]),
            ("dated_articles", ORACLES["site_dated_articles"]),
            ("time_articles", ORACLES["site_time_articles"]),
            ("front_page", ORACLES["site_front_page"]),
        )
    )
)
def site_all_rules(spark, sf_dir):
    """All walked rules in one job: pages routed by the registry, one pass over the page table."""
    pages, registry = None, None
    for rule, build in WALKED.items():
        named = _named(build(spark, sf_dir), rule)
        pages = named if pages is None else pages.unionByName(named)
    registry = pages.select("feed_name", "rule_id").distinct().withColumn("enabled", F.lit(None).cast("boolean"))
    details = _named(_note_links_details(spark, sf_dir), "note_links").unionByName(
        _named(_front_page_details(spark, sf_dir), "front_page")
    )
    routed = plans.route_pages(pages.drop("rule_id").withColumn("url", F.col("feed_name")), registry)
    rows = plans.site_entries(routed, details=details, rules=list(WALKED))
    # Research descriptions repeat the title and are not part of the SQL.
    shown = F.when(F.col("rule_id") != "research_cards", F.col("description"))
    return rows.select("feed_name", "link", "title", shown.alias("description"), stamp("published"))


@query(f"""
WITH o AS (
  SELECT *, 'https://shop.example/order/' || o_orderkey - (o_orderkey % 10 = 9)::INT AS link FROM orders WHERE o_orderkey % 17 <> 0
  QUALIFY row_number() OVER (PARTITION BY {SITE}, o_orderkey - (o_orderkey % 10 = 9)::INT ORDER BY o_orderkey) = 1),
known AS (
  SELECT {SITE} AS feed_name, link, upper(o_orderstatus) || ' ' || {TITLE} AS title,
         CASE WHEN o_orderkey % 5 = 0 THEN 'urgent' ELSE 'other' END AS category,
         CASE WHEN o_orderkey % 4 = 0 THEN 'Clerk of ' || o_orderkey ELSE upper(o_orderstatus) || ' ' || {TITLE} END AS description,
         CASE WHEN o_orderkey % 3 = 0 THEN {sql_fallback('link')} ELSE {DAY} END AS published
  FROM o)
SELECT feed_name, link, title, category, description, {sql_stamp('published')} AS published FROM known""")
def site_outside_rule(spark, sf_dir):
    """A rule that the package does not know, as one row of a table beside those it knows."""
    from feedloom.plans import rulebook

    rule = (
        "order_cards", "https://shop.example", "strip_slash", "query", "^/order/?$", 0, "first_valid", "non_blank", "other",
        ["d/M/yyyy"], ["unescape"],
        rulebook.program(
            [{"items": "ul.orders li"}],
            [
                {"field": "link", "path": ["a[href]"], "attr": "href"},
                {"field": "title", "path": ["b.gone"], "form": "tight"},
                {"field": "title", "path": ["a", "b"], "form": "collapsed", "min_chars": 4},
                {"field": "category", "attr": "data-mark", "pattern": "^1-", "value": "urgent"},
                {"field": "date", "path": ["time"], "take": "every", "reject": "^0"},
                {"field": "description", "path": ["p"], "take": "every", "reject": "(?i)^read more"},
            ],
        ),
        None,
    )
    book = rulebook.builtin_rules(spark).unionByName(rulebook.rule_rows(spark, [rule]))
    mark = F.when(_key() % 5 == 0, "1-URGENT").otherwise("5-LOW")
    heading = F.when(_key() % 17 == 0, "abc").otherwise(_text(F.upper("o_orderstatus"), " \n ", _title()))
    day = F.when(_key() % 3 == 0, "<time>some day</time>").otherwise(_text("<time>0/0/0000</time><time>", _written("d/M/yyyy"), "</time>"))
    about = F.when(_key() % 4 == 0, _text("<p>Read more here</p><p>Clerk of ", _key_text(), "</p>")).otherwise("")
    item = _text('<li data-mark="', mark, '"><a href="order/', _same_link(), '?ref=list"><b>', heading, "</b></a>", day, about, "</li>")
    pages = _pages(spark, sf_dir, "order_cards", item, '<ul class="orders"><li><a href="/order/"><b>All orders</b></a></li>', "</ul>")
    return _shown(plans.site_entries(pages, rulebook=book), "category", "description")
