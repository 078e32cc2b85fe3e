"""Queries for rendering, auditing and retiring feeds, and for choosing which feeds run."""

from pyspark.sql import functions as F

from feedloom.catalog.base import (
    PAGE_ENTRIES,
    dated_pages,
    query,
    scratch,
    sql_stamp,
    stamp,
    table,
)
from feedloom.functions.dates import parse_rfc822, parse_rfc822_strict
from feedloom.operators import audit, lifecycle, registry, render
from feedloom.operators.ordering import feed_order
from feedloom.plans.sites import known_rules
from feedloom.sources import feeds

BUILT = "2026-08-22 18:09:33"


def _sql_escape(value: str) -> str:
    clean = rf"regexp_replace({value}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{{7F}}-\x{{9F}}]', '', 'g')"
    return f"replace(replace(replace({clean}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


RENDERED = rf"""
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY feed_name ORDER BY published DESC NULLS FIRST, seq DESC, link DESC) AS feed_pos
  FROM dated_pages),
items AS (
  SELECT feed_name, feed_pos, (feed_pos - 1) // 3 AS part,
         '    <item>' || chr(10) ||
         '      <title>' || {_sql_escape("title")} || '</title>' || chr(10) ||
         '      <link>' || {_sql_escape("link")} || '</link>' || chr(10) ||
         '      <description>' || {_sql_escape("title")} || '</description>' || chr(10) ||
         '      <guid isPermaLink="false">' || {_sql_escape("link")} || '</guid>' || chr(10) ||
         coalesce('      <pubDate>' || strftime(published, '%a, %d %b %Y %H:%M:%S +0000') || '</pubDate>' || chr(10), '') ||
         '    </item>' || chr(10) AS item_xml
  FROM ordered),
bodies AS (
  SELECT feed_name, part, string_agg(item_xml, '' ORDER BY feed_pos) AS body,
         max(part) OVER (PARTITION BY feed_name) AS last_part,
         'https://feeds.example.org/feed_' || feed_name AS stem
  FROM items GROUP BY feed_name, part)
"""

RENDER_SQL = rf"""
WITH {PAGE_ENTRIES}, {RENDERED}
SELECT feed_name, CAST(part AS INTEGER) AS part,
  '<?xml version=''1.0'' encoding=''UTF-8''?>' || chr(10) ||
  '<rss xmlns:atom="http://www.w3.org/2005/Atom" xmlns:content="http://purl.org/rss/1.0/modules/content/" version="2.0">' || chr(10) ||
  '  <channel>' || chr(10) ||
  '    <title>Site ' || feed_name || '</title>' || chr(10) ||
  '    <link>https://' || feed_name || '/</link>' || chr(10) ||
  '    <description>Latest from ' || feed_name || '</description>' || chr(10) ||
  '    <atom:link href="' || stem || CASE WHEN part > 0 THEN '/' || part ELSE '' END || '.xml" rel="self"/>' || chr(10) ||
  '    <docs>http://www.rssboard.org/rss-specification</docs>' || chr(10) ||
  '    <generator>feedloom</generator>' || chr(10) ||
  CASE WHEN feed_name LIKE 'www.%' THEN
  '    <image>' || chr(10) ||
  '      <url>https://' || feed_name || '/logo.png</url>' || chr(10) ||
  '      <title>Site ' || feed_name || '</title>' || chr(10) ||
  '      <link>https://' || feed_name || '/</link>' || chr(10) ||
  '    </image>' || chr(10) ELSE '' END ||
  '    <language>en</language>' || chr(10) ||
  '    <lastBuildDate>Sat, 22 Aug 2026 18:09:33 +0000</lastBuildDate>' || chr(10) ||
  CASE WHEN part > 0 THEN '    <atom:link href="' || stem || CASE WHEN part > 1 THEN '/' || (part - 1) ELSE '' END || '.xml" rel="previous"/>' || chr(10) ELSE '' END ||
  CASE WHEN part < last_part THEN '    <atom:link href="' || stem || '/' || (part + 1) || '.xml" rel="next"/>' || chr(10) ELSE '' END ||
  CASE WHEN part > 0 THEN '    <opensearch:startIndex xmlns:opensearch="http://a9.com/-/spec/opensearch/1.1/">' || (3 * part + 1) || '</opensearch:startIndex>' || chr(10) ELSE '' END ||
  body || '  </channel>' || chr(10) || '</rss>' AS rss_xml
FROM bodies"""


def _documents(spark, sf_dir, entries=None):
    """Three items to a document, so that several feeds need more than one."""
    entries = dated_pages(spark, sf_dir) if entries is None else entries
    name = F.col("feed_name")
    site = F.concat(F.lit("https://"), name, F.lit("/"))
    channels = entries.select("feed_name").distinct().select(
        "feed_name",
        F.concat(F.lit("Site "), name).alias("title"),
        F.lit("A site").alias("description"),
        F.concat(F.lit("Latest from "), name).alias("subtitle"),
        F.lit("en").alias("language"),
        F.lit("Somebody").alias("author"),
        F.when(F.startswith(name, F.lit("www.")), F.concat(site, F.lit("logo.png"))).alias("logo"),
        site.alias("blog_url"),
    )
    items = render.feed_items(feed_order(entries))
    return render.render_feeds(items, channels, BUILT, "https://feeds.example.org", items_per_document=3)


@query(RENDER_SQL)
def render_feed(spark, sf_dir):
    return _documents(spark, sf_dir)


@query(rf"WITH {PAGE_ENTRIES}, {RENDERED} SELECT feed_name, feed_pos, item_xml FROM items")
def render_items(spark, sf_dir):
    return render.render_items(render.feed_items(feed_order(dated_pages(spark, sf_dir))))


@query(rf"""
WITH {PAGE_ENTRIES}, {RENDERED}
SELECT feed_name, feed_pos, title, link, title AS description, link AS guid, {sql_stamp("published")} AS published
FROM ordered""")
def read_feeds(spark, sf_dir):
    """Feed files written out, scanned and parsed: the items must come back as they were."""
    path = scratch(spark, "feeds")
    feeds.write_feeds(_documents(spark, sf_dir), path)
    items = feeds.feed_items(feeds.read_feeds(spark, path))
    return items.select("feed_name", "feed_pos", "title", "link", "description", "guid", stamp("published"))


@query(f"""
WITH {PAGE_ENTRIES} SELECT DISTINCT feed_name, link FROM dated_pages WHERE feed_name NOT LIKE 'm.%'""")
def feed_links(spark, sf_dir):
    """Documents of some sites are cut short: those feeds give no links."""
    documents = _documents(spark, sf_dir)
    cut = F.startswith("feed_name", F.lit("m."))
    xml = F.when(cut, F.substring_index("rss_xml", "</channel>", 1)).otherwise(F.col("rss_xml"))
    parsed = feeds.parse_feeds(documents.select("feed_name", xml.alias("xml")))
    return feeds.feed_links(feeds.feed_items(parsed))


AUDIT = """
feeds AS (SELECT c_name AS feed_name, c_custkey, c_custkey % 50 = 0 AS broken FROM customer),
found AS (
  SELECT o_custkey, count(*) AS n, max(CASE WHEN o_custkey % 11 <> 0 THEN o_orderdate + INTERVAL 1 HOUR END) AS newest
  FROM orders GROUP BY o_custkey),
judged AS (
  SELECT feed_name, broken, CASE WHEN broken THEN 0 ELSE coalesce(n, 0) END AS item_count,
         CASE WHEN NOT broken THEN newest END AS newest,
         CAST(floor((epoch(TIMESTAMP '2001-08-02 00:30:00') - epoch(newest)) / 86400) AS BIGINT) AS age
  FROM feeds LEFT JOIN found ON o_custkey = c_custkey),
audit AS (
  SELECT feed_name, item_count, newest,
         CASE WHEN broken THEN 'ERROR' WHEN item_count = 0 THEN 'EMPTY' WHEN age > 60 THEN 'STALE' ELSE 'OK' END AS status,
         CASE WHEN broken THEN 'XML parse error' WHEN item_count = 0 THEN '0 items'
              WHEN newest IS NULL THEN item_count || ' items, no parseable dates'
              WHEN age > 60 THEN item_count || ' items, newest: ' || strftime(newest, '%Y-%m-%d') || ' (' || age || ' days ago)'
              ELSE item_count || ' items, newest: ' || strftime(newest, '%Y-%m-%d') END AS message
  FROM judged)
"""


def _audit(spark, sf_dir):
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    states = customers.select(F.col("c_name").alias("feed_name"), (F.col("c_custkey") % 50 == 0).alias("broken"))
    names = customers.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("feed_name"))
    written = F.when(
        F.col("o_custkey") % 11 != 0,
        F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy"), F.lit(" 01:00:00 GMT")),
    ).otherwise("undated")
    items = orders.join(names, "o_custkey").select("feed_name", parse_rfc822(written).alias("published"))
    return audit.audit_feeds(items, states, "2001-08-02 00:30:00")


@query(f"""
WITH {AUDIT}
SELECT feed_name, item_count, {sql_stamp("newest")} AS newest_date, status, message FROM audit""")
def audit_feeds(spark, sf_dir):
    rows = _audit(spark, sf_dir)
    return rows.select("feed_name", "item_count", stamp("newest_date", "newest_date"), "status", "message")


@query(f"""
WITH {AUDIT}
SELECT status, count(*) AS n_feeds, status IN ('ERROR', 'EMPTY') AS failing FROM audit GROUP BY status
UNION ALL SELECT 'all', count(*), bool_or(status IN ('ERROR', 'EMPTY')) FROM audit""")
def audit_summary(spark, sf_dir):
    rows = _audit(spark, sf_dir)
    total = audit.audit_failed(rows).select(F.lit("all").alias("status"), "n_feeds", F.col("failed").alias("failing"))
    return audit.audit_summary(rows).unionByName(total)


# Orders as feed items: a customer is a feed, every 40th order is its retirement notice.
ITEMS = """
raw AS (
  SELECT 'c' || o_custkey AS feed_name,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS feed_pos,
         'Order ' || o_orderkey AS title, 'https://site.example/o/' || o_orderkey AS link,
         CASE WHEN o_orderkey % 40 = 7 THEN 'deprecation-notice-c' || o_custkey
              ELSE 'https://site.example/o/' || o_orderkey END AS guid,
         CASE WHEN o_orderkey % 80 <> 7 THEN o_orderdate END AS published
  FROM orders)
"""


def _items(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    site = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    link = F.concat(F.lit("https://site.example/o/"), key)
    notice = F.concat(F.lit(lifecycle.NOTICE_PREFIX), site)
    entries = table(spark, sf_dir, "orders").select(
        site.alias("feed_name"),
        link.alias("link"),
        F.concat(F.lit("Order "), key).alias("title"),
        F.lit("").alias("description"),
        F.lit(None).cast("string").alias("category"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("published"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderkey") % 40 == 7, notice).otherwise(link).alias("guid"),
    )
    written = F.when(F.col("seq") % 80 != 7, F.date_format("published", "EEE, dd MMM yyyy HH:mm:ss 'Z'"))
    ordered = feed_order(entries).withColumn("published", parse_rfc822_strict(written))
    return ordered.select(
        "feed_name", "feed_pos", "title", "link", "description", "guid", "category", "published"
    )


NOTICE_SQL = f"""
WITH {ITEMS},
asked AS (
  SELECT 'c' || c_custkey AS feed_name, c_custkey,
         CASE WHEN c_custkey % 2 = 0 THEN 'https://new.example/' || c_custkey END AS alternative
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT 'x' || c_custkey, c_custkey, NULL FROM customer WHERE c_mktsegment = 'BUILDING'),
existing AS (SELECT 'c' || c_custkey AS feed_name FROM customer),
present AS (SELECT DISTINCT feed_name FROM raw WHERE guid = 'deprecation-notice-' || feed_name)
SELECT feed_name, feed_pos, title, link, '' AS description, guid, {sql_stamp("published")} AS published FROM raw
UNION ALL
SELECT feed_name, coalesce((SELECT min(feed_pos) FROM raw r WHERE r.feed_name = asked.feed_name), 1) - 1,
       '[NOTICE] This feed is no longer maintained', alternative,
       'Moved.' || coalesce(chr(10) || chr(10) || 'Recommended alternative: ' || alternative, ''),
       'deprecation-notice-' || feed_name, '2024-05-01 00:00:00'
FROM asked
WHERE feed_name IN (SELECT feed_name FROM existing) AND feed_name NOT IN (SELECT feed_name FROM present)"""


@query(NOTICE_SQL)
def inject_notices(spark, sf_dir):
    """Notices for existing and unknown feeds, asked for twice."""
    customers = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    building = customers.where("c_mktsegment = 'BUILDING'")
    known = building.select(
        F.concat(F.lit("c"), key).alias("feed_name"),
        F.lit("Moved.").alias("message"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("https://new.example/"), key)).alias("alternative_url"),
    )
    unknown = building.select(
        F.concat(F.lit("x"), key).alias("feed_name"),
        F.lit("Moved.").alias("message"),
        F.lit(None).cast("string").alias("alternative_url"),
    )
    existing = customers.select(F.concat(F.lit("c"), key).alias("feed_name"))
    asked = known.unionByName(unknown)
    once = lifecycle.inject_notices(_items(spark, sf_dir), asked, existing, "2024-05-01 00:00:00")
    twice = lifecycle.inject_notices(once, asked, existing, "2024-06-01 00:00:00")
    return twice.select("feed_name", "feed_pos", "title", "link", "description", "guid", stamp("published"))


RETIRABLE = f"""
{ITEMS},
notices AS (
  SELECT feed_name, arg_min(published, feed_pos) AS noticed FROM raw
  WHERE starts_with(guid, 'deprecation-notice-') AND published IS NOT NULL GROUP BY feed_name),
going AS (
  SELECT feed_name, noticed, CAST(floor((epoch(TIMESTAMP '2000-06-01') - epoch(noticed)) / 86400) AS BIGINT) AS age_days
  FROM notices WHERE noticed < TIMESTAMP '2000-06-01' - INTERVAL 90 DAYS)
"""


@query(f"WITH {RETIRABLE} SELECT feed_name, {sql_stamp('noticed')} AS noticed_at, age_days FROM going")
def retirable_feeds(spark, sf_dir):
    rows = lifecycle.retire_feeds(_items(spark, sf_dir), "2000-06-01 00:00:00")
    return rows.select("feed_name", stamp("noticed_at", "noticed_at"), "age_days")


@query(f"""
WITH {RETIRABLE}
SELECT feed_name, feed_pos, guid FROM raw WHERE feed_name NOT IN (SELECT feed_name FROM going)""")
def retire_feeds(spark, sf_dir):
    rows = lifecycle.retire_feeds(_items(spark, sf_dir), "2000-06-01 00:00:00", apply=True)
    return rows.select("feed_name", "feed_pos", "guid")


# Customers as registered feeds.
REGISTERED = """
registered AS (
  SELECT c_name AS registry_name, 'feed_' || c_custkey AS feed_name, c_custkey,
         CASE c_custkey % 7 WHEN 6 THEN 'carrier_pigeon' WHEN 2 THEN 'selenium' WHEN 4 THEN 'selenium' ELSE 'requests' END AS fetch_type,
         CASE WHEN c_custkey % 13 = 5 THEN 'no_such_rule' ELSE 'front_page' END AS rule_id,
         coalesce(CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END, TRUE) AS enabled
  FROM customer),
checked AS (
  SELECT *, CASE WHEN fetch_type = 'carrier_pigeon' THEN 'unknown fetch type'
                 WHEN rule_id = 'no_such_rule' THEN 'no such rule' END AS problem
  FROM registered),
valid AS (SELECT * FROM checked WHERE problem IS NULL),
selected AS (
  SELECT registry_name, feed_name, c_custkey,
         CASE WHEN NOT enabled OR fetch_type = 'selenium' THEN 'skipped' ELSE 'selected' END AS status
  FROM valid),
outcomes AS (
  SELECT registry_name, feed_name,
         CASE WHEN status = 'skipped' THEN 'skipped'
              WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'successful' ELSE 'failed' END AS status
  FROM selected)
"""


def _registry(spark, sf_dir):
    key = F.col("c_custkey")
    kind = F.when(key % 7 == 6, "carrier_pigeon").when((key % 7).isin(2, 4), "selenium").otherwise("requests")
    enabled = F.when(key % 5 == 1, F.lit(False)).when(key % 5 != 0, F.lit(True))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("registry_name"),
        F.concat(F.lit("feed_"), key.cast("string")).alias("feed_name"),
        F.when(key % 13 == 5, "no_such_rule").otherwise("front_page").alias("rule_id"),
        kind.alias("fetch_type"),
        F.lit("https://site.example").alias("blog_url"),
        enabled.alias("enabled"),
    )
    return rows, known_rules(spark)


@query(f"""
WITH {REGISTERED}
SELECT registry_name, feed_name, rule_id, fetch_type, enabled, coalesce(problem, '') AS problem FROM checked""")
def feed_registry(spark, sf_dir):
    rows = registry.feed_registry(*_registry(spark, sf_dir))
    return rows.select(
        "registry_name", "feed_name", "rule_id", "fetch_type", "enabled", F.coalesce("problem", F.lit("")).alias("problem")
    )


@query(f"""
WITH {REGISTERED},
picked AS (SELECT min(registry_name) AS name FROM valid)
SELECT 'skip_selenium' AS mode, registry_name, feed_name, status FROM selected
UNION ALL
SELECT 'selenium_only', registry_name, feed_name,
       CASE WHEN NOT enabled OR fetch_type <> 'selenium' THEN 'skipped' ELSE 'selected' END FROM valid
UNION ALL
SELECT 'all', registry_name, feed_name, CASE WHEN NOT enabled THEN 'skipped' ELSE 'selected' END FROM valid
UNION ALL
SELECT 'one', 'no such feed', NULL, 'error'""")
def select_feeds(spark, sf_dir):
    known = registry.valid_registry(*_registry(spark, sf_dir))
    modes = {
        "skip_selenium": registry.select_feeds(known, skip_selenium=True),
        "selenium_only": registry.select_feeds(known, selenium_only=True),
        "all": registry.select_feeds(known),
        "one": registry.select_feeds(known, feed="no such feed"),
    }
    named = [rows.select(F.lit(mode).alias("mode"), "registry_name", "feed_name", "status") for mode, rows in modes.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def _outcomes(spark, sf_dir):
    known = registry.valid_registry(*_registry(spark, sf_dir))
    site = F.concat(F.lit("feed_"), F.col("o_custkey").cast("string"))
    entries = table(spark, sf_dir, "orders").select(site.alias("feed_name"))
    return registry.run_outcomes(registry.select_feeds(known, skip_selenium=True), entries)


@query(f"""
WITH {REGISTERED}
SELECT status, count(*) AS n_feeds, status = 'failed' AS failing FROM outcomes GROUP BY status""")
def run_summary(spark, sf_dir):
    return registry.run_summary(_outcomes(spark, sf_dir))


@query(f"WITH {REGISTERED} SELECT status, registry_name FROM outcomes")
def run_listing(spark, sf_dir):
    return registry.run_listing(_outcomes(spark, sf_dir))


@query(f"""
WITH {REGISTERED}
SELECT status, registry_name, row_number() OVER (PARTITION BY status ORDER BY registry_name, feed_name) AS list_pos
FROM outcomes""")
def run_listing_positions(spark, sf_dir):
    """The order of the listing, as a column."""
    return registry.listing_positions(_outcomes(spark, sf_dir))
