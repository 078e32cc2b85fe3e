"""Queries for extraction from pages and for the column functions."""

from pyspark.sql import functions as F

from feedloom.catalog.base import (
    PAGE_ENTRIES,
    page_entries,
    query,
    spread,
    sql_collapse,
    sql_fallback,
    sql_stamp,
    sql_unescape,
    stamp,
    table,
)
from feedloom.functions import dates, markup, text, urls
from feedloom.operators import extract
from feedloom.operators.filters import non_blank, valid_entry
from feedloom.sources.pages import decode_pages, page_snapshots


@query(rf"""
WITH h AS (
  SELECT page_id, 'https://' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS base,
         list_filter(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), lambda x: x <> '') AS hs
  FROM pages),
u AS (SELECT page_id, base, unnest(range(len(hs))) AS pos, hs FROM h),
v AS (SELECT page_id, base, pos, {sql_unescape("hs[pos + 1]")} AS href FROM u)
SELECT page_id, pos, href,
       CASE WHEN starts_with(href, 'http') THEN href
            WHEN starts_with(href, '/') THEN base || href
            ELSE base || '/' || href END AS link
FROM v""")
def extract_links(spark, sf_dir):
    pages = page_snapshots(spark, f"{sf_dir}/pages.parquet")
    site = F.concat(F.lit("https://"), urls.host(F.col("url")))
    links = extract.extract_links(pages.select("page_id", "html", site.alias("base")), "", F.col("base"), "rooted_or_bare")
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "link")


# What a plain search for anchors gets wrong: comments, scripts, three ways to quote, tags inside of values.
@query("""
WITH k AS (SELECT c_custkey AS page_id, c_custkey::VARCHAR AS k, c_custkey % 3 AS kind FROM customer)
SELECT page_id, 0::BIGINT AS pos, '/d' || k || '?x=1&y=2' AS href FROM k
UNION ALL SELECT page_id, 1, '/q' || k || '/e' FROM k
UNION ALL SELECT page_id, 2, '/u' || k FROM k
UNION ALL SELECT page_id, 3, CASE kind WHEN 0 THEN '/caf' || chr(233) || '/' ELSE '/cafe/' END || k FROM k WHERE kind < 2""")
def scan_links(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    kind = F.col("c_custkey") % 3
    accent = F.when(kind == 0, "caf&eacute;").when(kind == 1, "cafe")
    last = F.concat(F.lit("""<a title='<a href="/no">' href="/"""), accent, F.lit("/"), key, F.lit('">l</a>'))
    html = F.concat(
        F.lit('<!-- <a href="/c">no</a> --><a title="a > b" href="/d'), key, F.lit('?x=1&amp;y=2">d</a>'),
        F.lit("""<script>var s = '<a href="/s">';</script><A HREF='/q"""), key, F.lit("&#47;e'>q</A>"),
        F.lit('<a name="x">no</a><abbr href="/no">a</abbr><a data-href="/no"\nhref=/u'), key, F.lit(">u</a>"),
        F.coalesce(last, F.lit('<style>a::after { content: "<a href=/no>" }')),
    )
    customers = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    pages = customers.select(F.col("c_custkey").alias("page_id"), html.alias("html"))
    return extract.extract_links(pages).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(rf"""
WITH a AS (
  SELECT page_id, 'anchor' AS selector,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS ts
  FROM pages),
h AS (
  SELECT page_id, 'heading' AS selector, [''] AS hs,
         regexp_extract_all(html, '<h1>([^<]*)</h1>', 1) AS ts
  FROM pages),
u AS (SELECT page_id, selector, hs, ts, unnest(range(1, len(ts) + 1)) AS nth
      FROM (SELECT * FROM a UNION ALL SELECT * FROM h))
SELECT page_id, selector, nth, {sql_unescape("hs[nth]")} AS href,
       trim({sql_unescape("ts[nth]")}) AS node_text
FROM u""")
def select_nodes_anchors(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    nodes = extract.select_nodes(pages, {"anchor": "nav a[href]", "heading": "article h1"})
    # Two steps: the position inside a page needs no second look at the page.
    per_page = nodes.groupBy("page_id", "selector").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "pos",
                    F.coalesce(F.col("attrs")["href"], F.lit("")).alias("href"),
                    markup.node_text(F.struct("strings")).alias("node_text"),
                )
            )
        ).alias("found")
    )
    return per_page.select("page_id", "selector", F.posexplode("found").alias("at", "n")).select(
        "page_id", "selector", (F.col("at") + 1).cast("bigint").alias("nth"), "n.href", "n.node_text"
    )


@query(rf"""
WITH c AS (
  SELECT page_id,
         {sql_collapse(sql_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))} AS h1,
         {sql_collapse(sql_unescape("regexp_extract(html, '<title>(.*?)</title>', 1)"))} AS page_title,
         {sql_collapse(sql_unescape("regexp_extract(html, '<b>(.*?)<br>', 1)"))} AS bold
  FROM pages),
t AS (SELECT *, CASE WHEN length(h1) >= 5 THEN h1 WHEN length(page_title) >= 5 THEN page_title END AS title FROM c)
SELECT page_id, title, coalesce(CASE WHEN page_id % 3 <> 0 THEN nullif(bold, '') END, title) AS description
FROM t""")
def page_titles(spark, sf_dir):
    def inner(pattern):
        return text.collapse_space(text.unescape_common(F.regexp_extract("html", pattern, 1)))

    found = F.array(inner("<h1>(.*?)</h1>"), inner("<title>(.*?)</title>"))
    title = text.first_match(found, 5)
    bold = F.when(F.col("page_id") % 3 != 0, inner("<b>(.*?)<br>"))
    return table(spark, sf_dir, "pages").select(
        "page_id", title.alias("title"), text.description_or_title(bold, title).alias("description")
    )


@query(rf"""
WITH c AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw FROM pages)
SELECT page_id,
       CASE WHEN page_id % 2 = 0 THEN {sql_collapse(sql_unescape(sql_unescape("raw")))} ELSE '' END AS description,
       coalesce(nullif(CASE WHEN page_id % 2 = 0 THEN {sql_collapse(sql_unescape(sql_unescape("raw")))} ELSE '' END, ''),
                'page ' || page_id) AS shown
FROM c""")
def meta_description(spark, sf_dir):
    raw = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    tag = F.concat(F.lit('<META content="'), raw, F.lit('" name="description"/>'))
    pages = table(spark, sf_dir, "pages").withColumn(
        "html",
        F.when(F.col("page_id") % 2 == 0, F.replace(F.col("html"), F.lit("</head>"), F.concat(tag, F.lit("</head>"))))
        .otherwise(F.col("html")),
    )
    found = pages.select("page_id", extract.meta_description(F.col("html")).alias("description"))
    title = F.concat(F.lit("page "), F.col("page_id").cast("string"))
    return found.withColumn("shown", text.description_or_title(F.col("description"), title))


@query("""
WITH l AS (
  SELECT doc_id, list_transform(string_split(
           CASE doc_id % 3 WHEN 0 THEN 'Read More' || chr(10) WHEN 1 THEN 'READ MORE about it' || chr(10)
                ELSE '' END || text, chr(10)),
           lambda x: trim(x, ' \t\n\r' || chr(160))) AS ps
  FROM documents)
SELECT doc_id,
       list_filter(ps, lambda x: x <> '' AND lower(x) <> 'read more')[1] AS not_equal,
       list_filter(ps, lambda x: x <> '' AND NOT starts_with(lower(x), 'read more'))[1] AS not_prefix,
       list_filter(ps, lambda x: x <> '')[1] AS any_text
FROM l""")
def first_paragraph(spark, sf_dir):
    lead = (
        F.when(F.col("doc_id") % 3 == 0, "Read More\n")
        .when(F.col("doc_id") % 3 == 1, "READ MORE about it\n")
        .otherwise("")
    )
    lines = F.transform(F.split(F.concat(lead, F.col("text")), "\n"), text.strip)
    docs = table(spark, sf_dir, "documents").select("doc_id", lines.alias("ps"))
    return docs.select(
        "doc_id",
        text.first_paragraph(F.col("ps"), "equals").alias("not_equal"),
        text.first_paragraph(F.col("ps"), "prefix").alias("not_prefix"),
        text.first_paragraph(F.col("ps"), None).alias("any_text"),
    )


@query("""
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%b %d') ELSE o_orderpriority END AS c1,
         CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%B') ELSE o_orderstatus END AS c2,
         CASE WHEN o_orderkey % 4 = 0 THEN '/research/news/' ELSE '/research/' END || o_orderkey AS href
  FROM orders)
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 <> 0 THEN c1 WHEN o_orderkey % 5 <> 0 THEN c2 ELSE 'News' END AS category,
       CASE WHEN href LIKE '%/news/%' THEN 'News' ELSE 'Research' END AS section,
       coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, o_orderpriority) AS own
FROM o""")
def category_chain(spark, sf_dir):
    key = F.col("o_orderkey")
    first = F.when(key % 3 == 0, F.date_format("o_orderdate", "MMM dd")).otherwise(F.col("o_orderpriority"))
    second = F.when(key % 5 == 0, F.date_format("o_orderdate", "MMMM")).otherwise(F.col("o_orderstatus"))
    href = F.concat(F.when(key % 4 == 0, "/research/news/").otherwise("/research/"), key.cast("string"))
    element = F.when(key % 7 != 0, F.col("o_orderstatus")).otherwise("")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.first_category(F.array(first, second), "News").alias("category"),
        text.url_category(href).alias("section"),
        F.coalesce(text.null_if_blank(element), "o_orderpriority").alias("own"),
    )


@query(r"""
SELECT p_partkey,
       array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(w[1:1]) || w[2:]), ' ') || ' ' || p_partkey || 'B' AS title,
       p_name || ' "' || p_brand || '" \n' AS plain
FROM part""")
def slug_titles(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    slug = F.concat_ws("-", F.replace("p_name", F.lit(" "), F.lit("-")), F.concat(key, F.lit("b")))
    escaped = F.concat("p_name", F.lit(' \\"'), "p_brand", F.lit('\\" \\\\n'))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.slug_title(slug).alias("title"), text.unescape_backslash(escaped).alias("plain")
    )


@query(rf"""
WITH p AS (
  SELECT *, p_partkey // 20 AS page_id,
         CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END AS owner
  FROM part),
j AS (
  SELECT p.page_id, p.p_partkey, o.p_partkey AS okey, o.p_name AS oname, o.p_brand AS obrand
  FROM p JOIN part o ON o.p_partkey = p.owner),
t AS (
  SELECT page_id, p_partkey, 'https://site.example/engineering/part-' || okey AS link,
         CASE WHEN okey % 7 = 0 THEN 'Part ' || okey ELSE 'The ' || chr(92) || '"' || oname || chr(92) || '" part' END AS title,
         CASE WHEN okey % 5 = 0 THEN NULL ELSE 'About ' || obrand || chr(92) || 'n' END AS summary
  FROM j)
SELECT page_id, link, title, coalesce(summary, title) AS description, 'Engineering' AS category,
       {sql_stamp("TIMESTAMP '2020-01-01' + to_days((p_partkey % 1500)::INT)")} AS published
FROM t WHERE p_partkey % 11 <> 0""")
def embedded_articles(spark, sf_dir):
    key = F.col("p_partkey")
    owner = F.when(key % 10 == 9, key - 1).otherwise(key)
    day = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1500).cast("int"))
    day = F.when(key % 11 == 0, "soon").otherwise(day.cast("string"))

    def pair(name, value):
        return F.concat(F.lit(f'\\"{name}\\":\\"'), value, F.lit('\\"'))

    summary = F.when(key % 5 != 0, F.concat(F.lit(","), pair("summary", F.concat(F.lit("About "), "p_brand", F.lit("\\\\n")))))
    title = F.when(
        key % 7 != 0, F.concat(F.lit(","), pair("title", F.concat(F.lit('The \\\\\\"'), "p_name", F.lit('\\\\\\" part'))))
    )
    article = F.concat(
        F.lit("{"),
        pair("publishedOn", day),
        F.lit(',\\"slug\\":{\\"_type\\":\\"slug\\",'),
        pair("current", F.concat(F.lit("part-"), owner.cast("string"))),
        F.lit('},\\"type\\":\\"engineeringArticle\\"'),
        F.coalesce(summary, F.lit("")),
        F.coalesce(title, F.lit("")),
        F.lit("}"),
    )
    # Twenty parts to a page, so a page never grows with the table.
    articles = table(spark, sf_dir, "part").select(F.floor(key / 20).alias("page_id"), "p_partkey", article.alias("a"))
    pages = (
        spread(articles, "page_id")
        .groupBy("page_id")
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "a"))).alias("found"))
        .select(
            "page_id",
            F.concat(
                F.lit("<script>var publishedOn;</script><script>self.push('"),
                F.array_join(F.transform("found", lambda x: x["a"]), ""),
                F.lit("')</script>"),
            ).alias("html"),
        )
    )
    rows = extract.embedded_articles(pages, "https://site.example/engineering/").where(valid_entry())
    return rows.select("page_id", "link", "title", "description", "category", stamp("published"))


@query(rf"""
WITH e AS (
  SELECT event_id, event_id // 20 AS body_id, ts,
         CASE WHEN event_id % 7 = 0 THEN ' ' ELSE ' ' || event_type || ' & ' || user_id END AS title,
         CASE WHEN event_id % 11 <> 0 THEN '/p/' || event_id END AS k
  FROM events)
SELECT body_id, 'https://site.example' || k AS link, trim(title) AS title,
       {sql_stamp(f"CASE WHEN event_id % 5 = 0 THEN {sql_fallback("'https://site.example' || k")} ELSE date_trunc('day', ts) END")} AS published
FROM e WHERE k IS NOT NULL AND trim(title) <> ''""")
def json_listing(spark, sf_dir):
    key = F.col("event_id")
    title = F.when(key % 7 == 0, " ").otherwise(
        F.concat(F.lit(" "), "event_type", F.lit(" &amp; "), F.col("user_id").cast("string"))
    )
    day = F.when(key % 5 == 0, "not a day").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    row = F.struct(
        day.alias("date"),
        F.when(key % 11 != 0, F.concat(F.lit("/p/"), key.cast("string"))).alias("s3Key"),
        title.alias("title"),
    )
    rows = table(spark, sf_dir, "events").select(F.floor(key / 20).alias("body_id"), row.alias("r"))
    bodies = (
        spread(rows, "body_id")
        .groupBy("body_id")
        .agg(F.to_json(F.collect_list("r")).alias("body"))
    )
    rows = extract.json_listing(bodies, "https://site.example")
    return rows.select("body_id", "link", "title", stamp("published"))


@query("""
SELECT page_id,
       regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS site,
       rtrim(split_part(url, '?', 1), '/') AS link,
       (url LIKE '%/en' OR url LIKE '%/en/' OR url LIKE '%/en#%') AS is_index,
       CASE WHEN url LIKE 'https://%' THEN url WHEN url LIKE '/%' THEN 'https://b.example' || url END AS secure,
       'https://b.example/' || ltrim(regexp_replace(url, '^[a-z]+://[^/]+', ''), '/') AS moved
FROM pages""")
def canonical_urls(spark, sf_dir):
    url = F.col("url")
    path = F.regexp_replace("url", "^[a-z]+://[^/]+", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.host(url).alias("site"),
        urls.canonical_url(url).alias("link"),
        urls.is_index_page(url, "en").alias("is_index"),
        urls.absolute_url(url, "https://b.example", "https_or_rooted").alias("secure"),
        urls.absolute_url(path, "https://b.example", "strip_slash").alias("moved"),
    )


@query(rf"""
WITH d AS (SELECT doc_id, chr(1) || replace(text, ' ', ' ' || chr(127) || chr(9) || chr(133)) || chr(31) AS dirty FROM documents),
s AS (SELECT doc_id, regexp_replace(dirty, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{{7F}}-\x{{9F}}]', '', 'g') AS clean FROM d)
SELECT doc_id, length(clean) AS n_clean, md5(clean) AS clean_hash, md5({sql_collapse("clean")}) AS flat_hash,
       md5(replace(replace(replace(clean, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS escaped_hash
FROM s""")
def sanitize_text(spark, sf_dir):
    dirty = F.concat(F.lit("\x01"), F.replace("text", F.lit(" "), F.lit(" \x7f\t\x85")), F.lit("\x1f"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.sanitize_xml(dirty).alias("clean"))
    return docs.select(
        "doc_id",
        F.length("clean").cast("bigint").alias("n_clean"),
        F.md5("clean").alias("clean_hash"),
        F.md5(text.collapse_space(F.col("clean"))).alias("flat_hash"),
        F.md5(text.escape_xml(F.col("clean"))).alias("escaped_hash"),
    )


@query(rf"""
WITH d AS (SELECT doc_id, replace(text, ' ', ' &amp;lt; ') AS escaped FROM documents)
SELECT doc_id, md5({sql_unescape("escaped")}) AS common_hash,
       md5({sql_unescape(sql_unescape("escaped"))}) AS twice_hash
FROM d""")
def unescape_entities(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(
        "doc_id", F.replace("text", F.lit(" "), F.lit(" &amp;lt; ")).alias("escaped")
    )
    once = text.unescape_html(F.col("escaped"))
    return docs.select(
        "doc_id",
        F.md5(text.unescape_common(F.col("escaped"))).alias("common_hash"),
        F.md5(text.unescape_html(once)).alias("twice_hash"),
    )


@query(rf"""
SELECT o_orderkey,
       {sql_stamp('''CASE WHEN o_orderkey % 10 = 9 THEN NULL
         WHEN o_orderkey % 10 = 8 THEN date_trunc('month', o_orderdate) ELSE date_trunc('day', o_orderdate) END''')} AS published,
       {sql_stamp('''CASE WHEN o_orderkey % 10 IN (2, 6) THEN date_trunc('day', o_orderdate) END''')} AS weekday_led,
       {sql_stamp("date_trunc('day', o_orderdate)")} AS from_slug,
       {sql_stamp("date_trunc('day', o_orderdate)")} AS last_of_byline
FROM orders""")
def parse_dates(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    forms = [
        "MMM d, yyyy",
        "MMMM d, yyyy",
        "EEEE MMMM d, yyyy",
        "MMM dd yyyy",
        "yyyy-MM-dd",
        "M/d/yyyy",
        "EEEE MMM d, yyyy",
        "d MMMM yyyy",
        "MMMM yyyy",
    ]
    written = F.lit("no date")
    for number, form in enumerate(forms):
        written = F.when(key % 10 == number, F.date_format(day, form)).otherwise(written)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", written.alias("t"))
    patterns = [
        "MMM d, yyyy",
        "MMMM d, yyyy",
        "MMM d yyyy",
        "MMMM d yyyy",
        "yyyy-M-d",
        "M/d/yyyy",
        "d MMM yyyy",
        "d MMMM yyyy",
        "MMMM yyyy",
        "MMM yyyy",
    ]
    posted = F.concat(F.lit("POSTED on  "), F.col("t"))
    slug = F.concat(F.lit("/"), F.date_format(day, "yyyy-MM-dd"), F.lit("_order-"), key.cast("string"))
    byline = F.array(F.lit("By somebody"), F.date_format(day, "MMMM d, yyyy"))
    return orders.select(
        "o_orderkey",
        stamp(dates.parse_date(dates.strip_weekday(F.col("t"), comma=False), patterns)),
        stamp(
            dates.parse_date(dates.require_weekday(dates.strip_posted_on(posted)), ["MMMM d, yyyy", "MMM d, yyyy"]),
            "weekday_led",
        ),
        stamp(dates.slug_date(slug), "from_slug"),
        stamp(dates.parse_date(F.element_at(byline, -1), ["MMMM d, yyyy"]), "last_of_byline"),
    )


@query(rf"""
SELECT o_orderkey,
       {sql_stamp("CASE WHEN o_orderkey % 6 <> 0 THEN date_trunc('day', o_orderdate) END")} AS published,
       {sql_stamp("CASE WHEN o_orderkey % 6 <> 0 THEN date_trunc('day', o_orderdate) END")} AS first_parsed
FROM orders""")
def text_dates(spark, sf_dir):
    key = F.col("o_orderkey")
    day = F.when(key % 6 != 0, F.date_format("o_orderdate", "MMMM d, yyyy")).otherwise("June 99, 2020")
    running = F.concat(
        F.lit("Order in May, number "), key.cast("string"), F.lit(" of "), day, F.lit(" and not March 1, 1900.")
    )
    pieces = F.array(F.lit("no day"), day, F.when(key % 6 != 0, "Jan 1, 1901"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        stamp(dates.text_date(running)),
        stamp(dates.first_date(pieces, ["MMM d, yyyy", "MMMM d, yyyy"]), "first_parsed"),
    )


@query(f"SELECT page_id, url, {sql_stamp(sql_fallback('url'))} AS published FROM pages")
def fallback_dates(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", stamp(dates.fallback_date(F.col("url"))))


@query(rf"""
SELECT event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') AS written,
       {sql_stamp("date_trunc('second', ts)")} AS strict,
       {sql_stamp("date_trunc('minute', ts) - INTERVAL 2 HOURS")} AS lenient,
       CAST(floor((epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(date_trunc('second', ts))) / 86400) AS BIGINT) AS age_days
FROM events""")
def rfc822_round_trip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    written = dates.format_rfc822(F.col("ts"))
    short = F.concat(F.date_format("ts", "d MMM yyyy HH:mm"), F.lit(" +0200"))
    strict = dates.parse_rfc822_strict(written)
    return events.select(
        "event_id",
        written.alias("written"),
        stamp(strict, "strict"),
        stamp(dates.parse_rfc822(short), "lenient"),
        dates.whole_days("2024-02-01 12:00:00", strict).alias("age_days"),
    )


@query(rf"""
WITH {PAGE_ENTRIES},
p AS (
  SELECT page_id, split_part(title, ' ', 1) AS title,
         CASE WHEN page_id % 4 = 0 THEN regexp_replace(link, '^[a-z]+:', '') ELSE link END AS link,
         CASE WHEN page_id % 3 <> 0 THEN {sql_fallback("link")} END AS published
  FROM page_entries)
SELECT page_id,
       (length(title) >= 5 AND starts_with(link, 'http') AND published IS NOT NULL) AS strict,
       (length(title) >= 5 AND starts_with(link, 'http')) AS lax,
       (title <> '' AND link <> '') AS filled
FROM p""")
def valid_entries(spark, sf_dir):
    link = F.when(F.col("page_id") % 4 == 0, F.regexp_replace("link", "^[a-z]+:", "")).otherwise(F.col("link"))
    rows = page_entries(spark, sf_dir).select(
        "page_id",
        F.substring_index("title", " ", 1).alias("title"),
        link.alias("link"),
        F.when(F.col("page_id") % 3 != 0, dates.fallback_date(F.col("link"))).alias("published"),
    )
    return rows.select(
        "page_id",
        valid_entry().alias("strict"),
        valid_entry(require_date=False).alias("lax"),
        non_blank().alias("filled"),
    )


@query("""
SELECT 'feed-' || page_id % 50 AS feed_name, lower(hex(page_id // 50)) AS collection_id FROM pages
UNION
SELECT 'feed-' || page_id % 50, lower(md5(url)) FROM pages""")
def pagination_ids(spark, sf_dir):
    site = F.concat(F.lit("feed-"), (F.col("page_id") % 50).cast("string"))
    small = F.lower(F.hex(F.floor(F.col("page_id") / 50)))
    links = F.concat(
        F.lit('<a href="?'), small, F.lit('_page=2">2</a><a href="?'), F.md5("url"),
        F.lit('_page=3">3</a><a href="?'), small, F.lit('_page=4">4</a>'), F.col("html"),
    )
    pages = table(spark, sf_dir, "pages").select(site.alias("feed_name"), links.alias("html"))
    return extract.pagination_ids(pages)


@query("SELECT page_id, md5(html) AS html_hash, length(html) AS n_chars FROM pages")
def decode_pages_utf8(spark, sf_dir):
    raw = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return decode_pages(raw).select(
        "page_id", F.md5("html").alias("html_hash"), F.length("html").cast("bigint").alias("n_chars")
    )


@query("""
SELECT DISTINCT strftime(o_orderdate, '%B %Y') AS date_text, 'f' || o_custkey % 5 AS feed_name,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS published
FROM orders WHERE o_orderkey % 8 <> 0""")
def date_sections(spark, sf_dir):
    key = F.col("o_orderkey")
    shown = F.when(key % 8 != 0, F.date_format("o_orderdate", "MMMM yyyy")).otherwise("Undated")
    html = F.concat(F.lit('<body><div class="top date"><b>'), shown, F.lit("</b></div><div>other</div>"))
    site = F.concat(F.lit("f"), (F.col("o_custkey") % 5).cast("string"))
    pages = table(spark, sf_dir, "orders").select(site.alias("feed_name"), html.alias("html"))
    found = extract.date_sections(pages, ["MMMM d, yyyy", "MMM d, yyyy", "MMMM yyyy", "MMM yyyy"])
    return found.select("feed_name", "date_text", stamp("published"))
