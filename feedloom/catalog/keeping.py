"""Queries for de-duplication, merging, ordering and refreshing."""

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
from feedloom.operators import dedupe, merge
from feedloom.operators.filters import non_blank
from feedloom.operators.ordering import feed_order, sort_entries, sort_positions
from feedloom.sources import store
from feedloom.streaming.refresh import stream_refresh

# Events as cards: one site per event type, one link per user, some cards broken or undated.
CARDS = """
cards AS (
  SELECT event_type AS feed_name, 'https://site.example/u/' || user_id AS link, event_id AS pos,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Card ' || event_id END AS title,
         CASE WHEN event_id % 4 = 0 THEN date_trunc('second', ts) END AS published,
         event_id % 3 AS section
  FROM events)
"""
CARD_COLUMNS = ["feed_name", "link", "title", "pos"]


def cards(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed_name"),
        F.concat(F.lit("https://site.example/u/"), F.col("user_id").cast("string")).alias("link"),
        key.alias("pos"),
        F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("Card "), key.cast("string"))).alias("title"),
        F.when(key % 4 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("published"),
        (key % 3).alias("section"),
        "ts",
    )


@query(f"""
WITH {CARDS}
SELECT feed_name, link, title, pos FROM cards WHERE title <> ''
QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY pos) = 1""")
def dedupe_first_valid(spark, sf_dir):
    return dedupe.first_valid(cards(spark, sf_dir), non_blank()).select(*CARD_COLUMNS)


@query(f"""
WITH {CARDS}, firsts AS (
  SELECT * FROM cards QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY pos) = 1)
SELECT feed_name, link, title, pos FROM firsts WHERE title <> ''""")
def dedupe_first_seen(spark, sf_dir):
    return dedupe.first_seen(cards(spark, sf_dir), non_blank()).select(*CARD_COLUMNS)


@query(f"""
WITH {CARDS}
SELECT feed_name, link, title, min(pos) OVER (PARTITION BY feed_name, link) AS pos,
       {sql_stamp("published")} AS published
FROM cards WHERE title <> ''
QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY published IS NULL, cards.pos) = 1""")
def dedupe_first_dated(spark, sf_dir):
    chosen = dedupe.first_dated(cards(spark, sf_dir), non_blank())
    return chosen.select(*CARD_COLUMNS, stamp("published"))


@query(f"""
WITH {CARDS}
SELECT feed_name, link, title, pos, section FROM cards WHERE title <> ''
QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY section, pos) = 1""")
def dedupe_sections(spark, sf_dir):
    rows = cards(spark, sf_dir)
    parts = [rows.where(F.col("section") == s).drop("section") for s in range(3)]
    stacked = dedupe.union_sources(*parts, rank="section")
    chosen = dedupe.first_section(stacked, non_blank())
    return chosen.select(*CARD_COLUMNS, F.col("section").cast("bigint").alias("section"))


# Cards up to a moment are stored, the later ones are fresh.
HALVES = f"""
{CARDS},
timed AS (SELECT c.*, e.ts FROM cards c JOIN events e ON e.event_id = c.pos),
stored AS (
  SELECT feed_name, link, title, published, pos AS seq FROM timed
  WHERE title <> '' AND ts < TIMESTAMP '2024-01-03'
  QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY pos) = 1),
fresh AS (
  SELECT feed_name, link, title, published, pos AS seq FROM timed
  WHERE title <> '' AND ts >= TIMESTAMP '2024-01-03'),
added AS (
  SELECT feed_name, link, title, published, seq + (SELECT max(seq) FROM stored) + 1 AS seq
  FROM fresh f
  WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.feed_name = f.feed_name AND s.link = f.link)
  QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY f.seq) = 1),
merged AS (SELECT *, FALSE AS is_new FROM stored UNION ALL SELECT *, TRUE AS is_new FROM added)
"""


def halves(spark, sf_dir):
    early = F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz")
    columns = ["feed_name", "link", "title", "published", F.col("pos").alias("seq")]
    timed = cards(spark, sf_dir).where(non_blank())
    stored = dedupe.first_valid(timed.where(early), non_blank()).select(*columns)
    return timed.where(~early).select(*columns), stored


@query(f"""
WITH {HALVES}
SELECT feed_name, link, title, seq FROM fresh f
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.feed_name = f.feed_name AND s.link = f.link)""")
def new_entries(spark, sf_dir):
    fresh, stored = halves(spark, sf_dir)
    return merge.new_entries(fresh, stored).select("feed_name", "link", "title", "seq")


@query(f"WITH {HALVES} SELECT feed_name, link, title, {sql_stamp('published')} AS published, seq, is_new FROM merged")
def merge_entries(spark, sf_dir):
    fresh, stored = halves(spark, sf_dir)
    merged = merge.merge_entries(fresh, stored)
    return merged.select("feed_name", "link", "title", stamp("published"), "seq", "is_new")


@query(f"""
WITH {HALVES}
SELECT feed_name, count(*) FILTER (WHERE is_new) AS added, count(*) AS total FROM merged GROUP BY feed_name""")
def merge_stats(spark, sf_dir):
    fresh, stored = halves(spark, sf_dir)
    return merge.merge_stats(merge.merge_entries(fresh, stored))


@query(f"""
WITH {HALVES},
mode AS (SELECT *, feed_name IN ('click', 'error') AS is_full FROM (SELECT DISTINCT feed_name FROM fresh)),
known AS (SELECT * FROM stored WHERE feed_name <> 'view'),
kept AS (SELECT s.* FROM known s LEFT JOIN mode m USING (feed_name) WHERE NOT coalesce(m.is_full, FALSE)),
split AS (
  SELECT f.*, m.is_full OR f.feed_name NOT IN (SELECT feed_name FROM known) AS replacing
  FROM fresh f JOIN mode m USING (feed_name)),
merging AS (
  SELECT feed_name, link, title, published, seq + (SELECT max(seq) FROM kept) + 1 AS seq
  FROM split f WHERE NOT replacing
    AND NOT EXISTS (SELECT 1 FROM kept s WHERE s.feed_name = f.feed_name AND s.link = f.link)
  QUALIFY row_number() OVER (PARTITION BY feed_name, link ORDER BY f.seq) = 1)
SELECT feed_name, link, title, seq, FALSE AS is_new FROM kept
UNION ALL SELECT feed_name, link, title, seq, TRUE FROM merging
UNION ALL SELECT feed_name, link, title, seq, TRUE FROM split WHERE replacing""")
def refresh_entries(spark, sf_dir):
    fresh, stored = halves(spark, sf_dir)
    full = F.col("feed_name").isin("click", "error")
    known = stored.where(F.col("feed_name") != "view")  # one feed starts without a store
    return merge.refresh_entries(fresh, known, full).select("feed_name", "link", "title", "seq", "is_new")


@query(f"""
SELECT 'o' || o_custkey % 7 AS feed_name, 'https://site.example/o/' || o_orderkey AS link,
       CASE WHEN c_acctbal >= 0 AND o_orderkey % 2 = 0 THEN c_name ELSE 'Order ' || o_orderkey END AS description,
       {sql_stamp("CASE WHEN c_acctbal >= 0 AND o_orderkey % 2 = 0 THEN o_orderdate ELSE TIMESTAMP '2023-01-01' END")} AS published
FROM orders JOIN customer ON c_custkey = o_custkey""")
def enrich_details(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    link = F.concat(F.lit("https://site.example/o/"), F.col("o_orderkey").cast("string"))
    site = F.concat(F.lit("o"), (F.col("o_custkey") % 7).cast("string"))
    listing = orders.join(customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey").select(
        site.alias("feed_name"),
        link.alias("link"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("description"),
        F.lit("2023-01-01").cast("timestamp_ntz").alias("published"),
    )
    details = (
        orders.where("o_orderkey % 2 = 0")
        .join(customers.where("c_acctbal >= 0"), orders["o_custkey"] == customers["c_custkey"])
        .select(
            site.alias("feed_name"),
            link.alias("link"),
            F.col("c_name").alias("description"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("published"),
        )
    )
    joined = merge.enrich_details(listing, details, ["description", "published"])
    return joined.select("feed_name", "link", "description", stamp("published"))


@query(f"""
SELECT 'o' || o_custkey % 7 AS feed_name, 'https://site.example/o/' || o_orderkey AS link,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Order ' || o_orderkey ELSE o_orderpriority END AS description,
       {sql_stamp("CASE WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '2023-01-01' ELSE o_orderdate END")} AS published
FROM orders""")
def enrich_details_versions(spark, sf_dir):
    """Two detail rows for each link: the first version counts, and where it lacks a value the listing's own stays."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    named = orders.select(
        F.concat(F.lit("o"), (F.col("o_custkey") % 7).cast("string")).alias("feed_name"),
        F.concat(F.lit("https://site.example/o/"), key.cast("string")).alias("link"),
        "o_orderkey",
        "o_orderpriority",
        "o_orderdate",
    )
    listing = named.select(
        "feed_name",
        "link",
        F.concat(F.lit("Order "), key.cast("string")).alias("description"),
        F.lit("2023-01-01").cast("timestamp_ntz").alias("published"),
    )
    first = named.select(
        "feed_name",
        "link",
        F.lit(1).alias("version"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("description"),
        F.when(key % 2 != 0, F.col("o_orderdate").cast("timestamp_ntz")).alias("published"),
    )
    second = named.select(
        "feed_name", "link", F.lit(2), F.lit("A later version"), F.lit("1999-01-01").cast("timestamp_ntz")
    )
    joined = merge.enrich_details(listing, first.union(second), ["description", "published"], order=["version"])
    return joined.select("feed_name", "link", "description", stamp("published"))


@query(f"""
WITH {PAGE_ENTRIES}
SELECT feed_name, link, title, {sql_stamp("published")} AS published,
       row_number() OVER (PARTITION BY feed_name ORDER BY published DESC NULLS FIRST, seq DESC, link DESC) AS feed_pos
FROM dated_pages""")
def current_feeds(spark, sf_dir):
    """The current feed of every site, in document order."""
    ordered = feed_order(dated_pages(spark, sf_dir))
    return ordered.select("feed_name", "link", "title", stamp("published"), "feed_pos")


FEED_ORDER_SQL = f"""
WITH {CARDS}
SELECT feed_name, pos, link, {sql_stamp("published")} AS published,
       row_number() OVER (PARTITION BY feed_name ORDER BY published DESC NULLS FIRST, pos DESC) AS feed_pos,
       row_number() OVER (PARTITION BY feed_name ORDER BY published ASC NULLS LAST, pos) AS sort_pos
FROM cards"""


@query(FEED_ORDER_SQL)
def feed_order_in_windows(spark, sf_dir):
    """Few feeds with many entries each, numbered feed by feed."""
    entries = cards(spark, sf_dir).withColumn("seq", F.col("pos"))
    return _positions(feed_order(entries))


@query(FEED_ORDER_SQL)
def feed_order_in_slices(spark, sf_dir):
    """The same, with the sort order numbered by itself instead of read backwards."""
    entries = cards(spark, sf_dir).withColumn("seq", F.col("pos"))
    both = sort_positions(feed_order(entries))
    return both.select("feed_name", "pos", "link", stamp("published"), "feed_pos", "sort_pos")


def _positions(ordered):
    # Sort order is document order read backwards.
    total = ordered.groupBy("feed_name").count()
    return ordered.join(total, "feed_name").select(
        "feed_name", "pos", "link", stamp("published"), "feed_pos", (F.col("count") + 1 - F.col("feed_pos")).alias("sort_pos")
    )


@query(f"WITH {HALVES} SELECT feed_name, link, title, {sql_stamp('published')} AS published FROM merged")
def sorted_store(spark, sf_dir):
    fresh, stored = halves(spark, sf_dir)
    ordered = sort_entries(merge.merge_entries(fresh, stored))
    return ordered.select("feed_name", "link", "title", stamp("published"))


@query(f"""
WITH {HALVES}
SELECT feed_name, link, title, {sql_stamp('published')} AS published,
       row_number() OVER (PARTITION BY feed_name ORDER BY published NULLS LAST, seq, link) AS sort_pos
FROM merged""")
def sorted_positions(spark, sf_dir):
    """The order of the merged store, as a column."""
    fresh, stored = halves(spark, sf_dir)
    ordered = sort_positions(merge.merge_entries(fresh, stored))
    return ordered.select("feed_name", "link", "title", stamp("published"), "sort_pos")


@query(f"""
WITH {PAGE_ENTRIES}
SELECT feed_name, link, title, {sql_stamp("published")} AS published, seq,
       '2024-06-01 00:00:00' AS last_updated FROM dated_pages""")
def store_round_trip(spark, sf_dir):
    path = scratch(spark, "store")
    store.write_entry_store(dated_pages(spark, sf_dir), path, "2024-06-01 00:00:00")
    back = store.read_entry_store(spark, path)
    return back.select("feed_name", "link", "title", stamp("published"), "seq", stamp("last_updated", "last_updated"))


@query(f"""
WITH {PAGE_ENTRIES}
SELECT feed_name, link, title,
       {sql_stamp('''CASE seq % 4 WHEN 0 THEN published WHEN 1 THEN published - INTERVAL 2 HOURS
                     WHEN 2 THEN (TIMESTAMP '2023-01-01' + to_days((('0x' || substr(md5(link), 1, 8))::BIGINT % 730)::INT)) END''')} AS published
FROM dated_pages""")
def typed_entries(spark, sf_dir):
    """Dates come back from ISO text; a bad text gets the stand-in date, NULL stays."""
    kind = F.col("seq") % 4
    day = F.date_format("published", "yyyy-MM-dd")
    text = (
        F.when(kind == 0, day)
        .when(kind == 1, F.concat(day, F.lit("T00:00:00+02:00")))
        .when(kind == 2, F.lit("sometime"))
    )
    rows = dated_pages(spark, sf_dir).withColumn("date", text).drop("published")
    return store.typed_entries(rows).select("feed_name", "link", "title", stamp("published"))


STREAM_SQL = f"""
WITH {PAGE_ENTRIES}
SELECT feed_name, link, {sql_stamp("published")} AS published, count(*) OVER (PARTITION BY feed_name) AS n
FROM dated_pages"""


@query(STREAM_SQL)
def stream_refresh_store(spark, sf_dir):
    """Page files as a stream into the store; a second run over the same files adds nothing."""
    root = scratch(spark, "stream")
    pages = dated_pages(spark, sf_dir)
    # Three files a batch, so that later batches meet a store that is not empty.
    pages.unionByName(pages).repartition(6).write.parquet(f"{root}/pages")
    for checkpoint in ("first", "second"):
        stream_refresh(
            spark,
            f"{root}/pages",
            pages.schema,
            f"{root}/store",
            f"{root}/{checkpoint}",
            lambda batch: batch,
            "2024-06-01 00:00:00",
            max_files=3,
        ).awaitTermination()
    stored = store.read_entry_batches(spark, f"{root}/store")
    total = stored.groupBy("feed_name").agg(F.count(F.lit(1)).alias("n"))
    return stored.join(total, "feed_name").select("feed_name", "link", stamp("published"), "n")

