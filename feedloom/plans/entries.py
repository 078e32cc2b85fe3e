"""From listing pages of all sites to entries, in one pass over the pages.

Each page is walked once under the rule of its site. Rules are rows (``rulebook``) that travel with the
pages, so the page table is not read once per site and a new site needs no code.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates, markup, text
from feedloom.operators import extract
from feedloom.operators.dedupe import first_by
from feedloom.operators.filters import non_blank, valid_entry
from feedloom.operators.joins import join_dimension
from feedloom.operators.merge import new_entries
from feedloom.operators.pagination import pagination_frontier
from feedloom.plans.rulebook import builtin_rules, first_of_patterns, is_listing, json_rule, option, read_listing, with_rules, with_shapes
from feedloom.plans.sites import BASE_URLS
from feedloom.session import cut_lineage, dealt


def route_pages(pages: DataFrame, registry: DataFrame) -> DataFrame:
    """Pages of enabled feeds, with the rule of their feed."""
    routes = registry.where(F.coalesce("enabled", F.lit(True))).select("feed_name", "rule_id")
    return join_dimension(pages, routes, ["feed_name"], spread_by=["url"], costly=True)


def _settle(df: DataFrame) -> DataFrame:
    """Compute the columns here, once per row.

    Filters and aggregates further up would otherwise pull the long chains of fallbacks
    into their own conditions and work them out again. A generator stops that.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _with_defaults(pages: DataFrame) -> DataFrame:
    """Page number 1, no collection and the rule's own base URL unless the table says more."""
    base = F.create_map(*[F.lit(x) for pair in BASE_URLS.items() for x in pair])[F.col("rule_id")]
    defaults = {**{c: F.lit(v) for c, v in _PLACE.items()}, "base_url": base}
    return pages.withColumns({c: v for c, v in defaults.items() if c not in pages.columns})


PAGE = ["feed_name", "rule_id", "page_no", "collection_id"]
CANDIDATE = [*PAGE, "section", "pos", "link", "title", "description", "category", "published", "usable", "valid", "dedupe"]


def listing_candidates(
    pages: DataFrame, rules: Collection[str] | None = None, rulebook: DataFrame | None = None
) -> DataFrame:
    """Every item of every listing page, resolved but neither filtered nor de-duplicated.

    ``usable`` is false for index pages and items without a link, ``valid`` tells whether
    the entry passes the checks of its rule. ``published`` is NULL where no date was read.
    ``rulebook`` holds the rules as rows (``rulebook.RULE``; by default those of the known sites);
    ``rules`` names the rules in use: pages of others are passed over.
    """
    book = _book(pages.sparkSession, rulebook, rules)
    shown = pages.withColumns({c: F.lit(v) for c, v in _PLACE.items() if c not in pages.columns})
    base = ["base_url"] if "base_url" in pages.columns else []
    read = read_listing(with_rules(shown.select(*PAGE, *base, "html"), book), PAGE)
    settled = _settle(read).withColumn("description", F.coalesce("description", "title"))
    return _judge(settled).select(*CANDIDATE)


_PLACE = {"page_no": 1, "collection_id": ""}


def _book(spark: SparkSession, rulebook: DataFrame | None, rules: Collection[str] | None) -> DataFrame:
    book = builtin_rules(spark) if rulebook is None else rulebook
    return book if rules is None else book.where(F.col("rule_id").isin(list(rules)))


def _judge(resolved: DataFrame) -> DataFrame:
    """Add ``usable`` and ``valid``. Every rule that asks for a date also has a stand-in date."""
    listing = is_listing(F.col("href"), F.col("listing"))
    valid = (
        F.when(F.col("validate").isin("strict", "lax"), valid_entry(require_date=False))
        .when(F.col("validate") == "titled", F.col("title").isNotNull())
        .otherwise(non_blank())
    )
    usable = F.col("link").isNotNull() & ((F.col("href") != "") | option("blank_href")) & ~listing
    return resolved.withColumns({"usable": F.coalesce(usable, F.lit(False)), "valid": valid})


def choose_entries(candidates: DataFrame) -> DataFrame:
    """One row per link under the de-duplication policy of its rule, with ``seq``.

    One aggregation serves all policies, so there is one shuffle, on feed and link, with
    partial aggregation in front of it:

    * first valid  — invalid rows are dropped before;
    * first seen   — the first row wins and is dropped afterwards if it is invalid;
    * first dated  — inside the first page a dated row wins, at the place of the first row.
    """
    seen = F.col("dedupe") == "first_seen"
    undated_last = (F.col("dedupe") == "first_dated") & F.col("published").isNull()
    rows = candidates.where(F.col("usable") & (F.col("valid") | seen))

    # The winner is the least of its place and then its texts (two snapshots of one page can show different texts in one
    # place), so that each value goes through the sort and the shuffle once, in few words: two numbers are the place, and
    # a description that repeats the title is a flag.
    spot = F.shiftleft(F.col("section").cast("bigint"), 32) + F.col("pos")
    same = F.col("description").eqNullSafe(F.col("title"))
    whole = F.struct(
        (F.col("page_no").cast("bigint") * 2 + F.coalesce(undated_last, F.lit(False)).cast("int")).alias("page"),
        spot.alias("spot"),
        "collection_id",
        "title",
        F.when(~same, F.col("description")).alias("description"),
        "category",
        "published",
        "rule_id",
        (F.col("valid").cast("int") + 2 * same.cast("int")).alias("flags"),
    )
    # Only a dated winner can stand behind the first row of its link.
    here = F.when(F.col("dedupe") == "first_dated", F.struct("page_no", spot))
    first = F.min_by(arrival(F.col("page_no"), F.col("section"), F.col("pos")), here)
    chosen = rows.groupBy("feed_name", "link").agg(F.min(whole).alias("w"), first.alias("at"))
    return chosen.where("w.flags % 2 = 1").select(
        "feed_name",
        "w.rule_id",
        "link",
        "w.title",
        F.when(F.col("w.flags") >= 2, F.col("w.title")).otherwise(F.col("w.description")).alias("description"),
        "w.category",
        "w.published",
        F.least(F.shiftleft(F.shiftright("w.page", 1), 40) + F.col("w.spot"), "at").alias("seq"),
    )


def arrival(page_no: Column, section: Column, pos: Column) -> Column:
    """Order of arrival as one number: page, then section, then place on the page."""
    return (
        F.shiftleft(page_no.cast("bigint"), 40) + F.shiftleft(section.cast("bigint"), 32) + pos.cast("bigint")
    )


def crawl_candidates(candidates: DataFrame, pages: DataFrame, page_limit: int | None = None) -> DataFrame:
    """Candidates on the pages a crawl would have read (see ``pagination_frontier``).

    Page 1 of a feed belongs to each of its collections.
    """
    pages = _with_defaults(pages).select(*PAGE)

    def shared(df: DataFrame) -> DataFrame:
        named = pages.where("collection_id <> ''").select("feed_name", "collection_id").distinct()
        base = df.where("page_no = 1 AND collection_id = ''").drop("collection_id")
        spread = [c for c in ("link", "page_no") if c in df.columns][:1]
        return df.unionByName(join_dimension(base, named, ["feed_name"], spread_by=spread))

    shown = candidates.where("usable AND valid").select(
        "feed_name", "collection_id", "page_no", "section", "pos", "link"
    )
    found = pagination_frontier(shared(shown), shared(pages), page_limit)
    kept = found.select("feed_name", "link", "page_no").distinct()
    # The frontier decides on pages and links; all copies on the chosen page stay for the
    # de-duplication. Single-page rules have nothing to crawl and keep every row.
    one_page = candidates.where("page_no = 1")
    later = candidates.where("page_no > 1").join(kept, ["feed_name", "link", "page_no"], "left_semi")
    return one_page.unionByName(later)


def with_details(
    entries: DataFrame,
    details: DataFrame,
    order: Sequence[str] = (),
    rules: DataFrame | None = None,
    placed: bool = False,
) -> DataFrame:
    """Entries and what their own pages say: detail_date, detail_text.

    ``rules`` holds ``detail`` and ``date_patterns`` by rule; without it they are columns of the entries.
    Bodies meet the entries before they are read and are read where they meet; only dates and texts go on.
    Of several pages of one link the first by ``order`` counts, as a whole; ties go by a hash of the body.
    Bodies of links without an entry are not read, nor are those that do not count. ``placed`` entries lie by feed and
    link, as de-duplication leaves them: bodies are brought to them, and they are not shuffled again.
    """
    key = ["feed_name", "link"]
    ranks = {f"_rank{n}": F.col(c) for n, c in enumerate(order)}
    bodies = details.select(*key, F.col("html").alias("detail_html"), *[c.alias(n) for n, c in ranks.items()])
    if placed:  # a fixed number again, so that AQE leaves these costly rows as they are
        bodies = bodies.repartition(int(details.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
    else:
        entries, bodies = dealt(entries, *key), dealt(bodies, *key)
    met = entries.join(bodies, key, "left")
    # The hash that breaks ties is worked out behind the shuffle.
    asked = first_by(met, [*ranks, F.xxhash64("detail_html")]).drop(*ranks)
    if rules is None:
        asked = with_shapes(asked)
    else:  # after the shuffle, which the programs need not go through
        asked = join_dimension(asked, with_shapes(rules), ["rule_id"], "left", spread_by=["link"])
    walked = asked.withColumn("items", markup.read_items(F.col("detail_html"), F.col("detail"))).drop("detail_html")
    described = F.filter(F.transform("items", lambda i: i["description"]), lambda d: d.isNotNull())
    read = walked.withColumns(
        {
            "detail_date": first_of_patterns(F.get("items", F.lit(0))["dates"], F.col("date_forms"), F.col("date_shape")),
            "detail_text": text.collapse_space(text.unescape_html(F.get(described, F.lit(0)))),
        }
    )
    return read.select(*key, *[c for c in entries.columns if c not in key], "detail_date", "detail_text")


def site_entries(
    pages: DataFrame,
    bodies: DataFrame | None = None,
    details: DataFrame | None = None,
    stored: DataFrame | None = None,
    crawl: bool = True,
    rules: Collection[str] | None = None,
    page_limit: int | None = None,
    rulebook: DataFrame | None = None,
) -> DataFrame:
    """Fresh entries of all sites.

    ``pages``    feed_name, rule_id, html; optional page_no, collection_id, base_url
    ``bodies``   feed_name, body (JSON listings); optional base_url
    ``details``  feed_name, link, html of the entries' own pages
    ``stored``   known entries: their links are left out before the detail pages are read
    ``crawl``    all pages up to the frontier, or (False) page 1 only
    ``rules``    the rules in use, if known; fewer rules make a smaller plan
    ``rulebook``  rules as rows; by default those of the known sites (see ``plans.rulebook``)
    ``page_limit``  the last page a crawl reads; None reads all of them up to the frontier
    """
    if not crawl and "page_no" in pages.columns:
        pages = pages.where("page_no = 1")
    embedded = pages.where("rule_id = 'embedded_json'")
    walked = pages.where("rule_id <> 'embedded_json'")

    candidates = listing_candidates(walked, rules, rulebook)
    if crawl and "page_no" in pages.columns:
        # The crawl looks at the candidates several times; the pages are walked only once.
        candidates = crawl_candidates(cut_lineage(candidates), walked, page_limit)
    if bodies is not None:
        candidates = candidates.unionByName(listing_bodies(bodies))
    fresh = resolve_entries(candidates, details, stored, rulebook)
    if rules is not None and "embedded_json" not in rules:
        return fresh
    return fresh.unionByName(embedded_entries(embedded, stored))


def resolve_entries(
    candidates: DataFrame,
    details: DataFrame | None = None,
    stored: DataFrame | None = None,
    rulebook: DataFrame | None = None,
) -> DataFrame:
    """Entries from candidates: de-duplicated, without those that are stored, with details, dates and clean texts."""
    fresh = choose_entries(candidates)
    if stored is not None:
        fresh = new_entries(fresh, stored, unique=True)

    spark = candidates.sparkSession
    book = _book(spark, rulebook, None)
    if rulebook is None:
        book = book.unionByName(json_rule(spark))
    if details is not None:
        readings = book.select("rule_id", "date_patterns", "detail")
        fresh = with_details(fresh, details, rules=readings, placed=True).withColumns(
            {
                "published": F.coalesce("detail_date", "published"),
                "description": F.coalesce(text.null_if_blank(F.col("detail_text")), "description"),
            }
        )
    fresh = join_dimension(fresh, book.select("rule_id", "options"), ["rule_id"], "left", spread_by=["link"])
    published = F.when(option("undated"), F.col("published")).otherwise(
        F.coalesce("published", dates.fallback_date(F.col("link")))
    )
    clean_title = text.unescape_html(F.col("title"))
    clean_description = text.unescape_html(F.col("description"))
    return fresh.select(
        "feed_name",
        "rule_id",
        "link",
        F.when(option("strip_title"), text.strip(clean_title))
        .when(option("unescape"), clean_title)
        .otherwise(F.col("title"))
        .alias("title"),
        F.when(option("squeeze"), text.collapse_space(clean_description))
        .when(option("unescape"), clean_description)
        .otherwise(F.col("description"))
        .alias("description"),
        "category",
        published.alias("published"),
        "seq",
    )


def listing_bodies(bodies: DataFrame) -> DataFrame:
    """JSON listings as candidates of the shared de-duplication."""
    rows = extract.json_listing(
        _with_defaults(bodies.withColumn("rule_id", F.lit("json_listing"))), F.col("base_url")
    )
    return rows.select(
        *PAGE,
        F.lit(0).alias("section"),
        "pos",
        "link",
        "title",
        F.col("title").alias("description"),
        F.lit(None).cast("string").alias("category"),
        "published",
        F.lit(True).alias("usable"),
        non_blank().alias("valid"),
        F.lit("first_valid").alias("dedupe"),
    )


def embedded_entries(pages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Entries from embedded JSON: checked, but copies of one link are all kept."""
    found = extract.embedded_articles(_with_defaults(pages), F.col("base_url")).where(valid_entry())
    rows = found.select(
        "feed_name",
        "rule_id",
        "link",
        "title",
        "description",
        "category",
        "published",
        arrival(F.col("page_no"), F.lit(0), F.col("pos")).alias("seq"),
    )
    if stored is not None:
        rows = new_entries(rows, stored)
    return rows


def extraction_quality(candidates: DataFrame) -> DataFrame:
    """Per feed: items found, distinct usable links of unknown structure, valid entries."""
    place = F.struct("page_no", "section", "pos")
    per_link = candidates.groupBy("feed_name", "link", "usable").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("valid", place).alias("valid")
    )
    return per_link.groupBy("feed_name").agg(
        F.sum("n").alias("links_found"),
        F.count_if(F.col("usable") & ~F.col("valid")).alias("unknown_structures"),
        F.count_if(F.col("usable") & F.col("valid")).alias("valid_entries"),
    )
