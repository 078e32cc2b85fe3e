"""Rules as rows of a table: a new site needs a row, no code.

A rule's row holds the program of the walk (see ``markup.read_items``) and its policies. Rows travel with the
pages of their feeds, so one pass serves any number of rules. ``builtin_rules`` states the rules of the known
sites in the same form.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import dates, markup, text, urls
from feedloom.operators.joins import join_dimension
from feedloom.plans.rules import DATE_PATTERNS, DETAIL_LAYOUTS, LAYOUTS, POLICIES
from feedloom.plans.sites import BASE_URLS

#: ``url_mode`` is one of ``urls.absolute_url``; ``tidy`` cuts "slashes" or "query" (and slashes) from the link; hrefs that
#: match ``listing`` are listing pages; ``options`` hold blank_href, unescape, squeeze, strip_title, undated.
RULE = (
    "rule_id STRING, base_url STRING, url_mode STRING, tidy STRING, listing STRING, place INT, dedupe STRING, "
    "validate STRING, default_category STRING, date_patterns ARRAY<STRING>, options ARRAY<STRING>, program STRING, detail STRING"
)
POLICY = ["dedupe", "validate"]
URL_MODES = ("prefix", "strip_slash", "rooted_or_bare", "prefix_rooted", "https_or_rooted")


def rule_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rules stated in code, as a relation whose size Spark knows: it is then sent to the pages, not they to it.

    Tables read from files have a known size, too. Frames made of Python rows have none.
    """
    kinds = {"STRING": pa.string(), "INT": pa.int32(), "ARRAY<STRING>": pa.list_(pa.string())}
    names = [f.split(" ", 1) for f in RULE.split(", ")]
    columns = zip(*rows, strict=True)
    return spark.createDataFrame(pa.table({n: pa.array(c, type=kinds[k]) for (n, k), c in zip(names, columns, strict=True)}))


def program(sections: list[dict], reads: list[dict]) -> str:
    return json.dumps({"sections": sections, "reads": reads})


# --- the rules of the known sites -------------------------------------------------------------

_MONTHS = "|".join(text.MONTH_MARKS)
# How each field is read: form of the text and what else its reads ask for. Which nodes are read is in LAYOUTS.
_FORMS = {
    "research_cards": {"title": {"form": "collapsed", "min_chars": 5}},
    "dyn_items": {k: {"form": "tight"} for k in ("title", "category", "description")},
    "dated_articles": {
        "date": {"form": "tight", "pattern": rf"(?is)^(?:posted on\s+)?(?:{dates.WEEKDAYS})\s+(.*)$"},
        "description": {"form": "spaced", "reject": r"(?i)^read more\Z"},
    },
    "time_articles": {
        "title": {"form": "tight", "min_chars": 0},
        "date": {"form": "tight", "pattern": rf"(?is)^(?:(?:{dates.WEEKDAYS}),\s+)?(.*)$"},
        "description": {"form": "spaced", "reject": r"(?i)^read more"},
    },
    "front_page": {"date": {"form": "tight"}, "category": {"form": "tight"}},
    "news_cards": {"category": {"min_chars": 0, "reject": _MONTHS}},
    "note_links": {"title": {"min_chars": 0}, "description": {"min_chars": 0}},
}
_LINK_TEXT = {"form": "tight", "min_chars": 0}


def _reads(rule: str) -> list[dict]:
    reads: list[dict] = []
    anchors = rule in ("news_cards", "research_cards", "note_links")
    if anchors:
        reads.append({"field": "link", "attr": "href", "min_chars": 0})
    for number, section in enumerate(LAYOUTS[rule]):
        for name, candidates in section["fields"].items():
            field = {"link": "link", "other_title": "title"}.get(name, name)
            every, near = name in section.get("every", ()), name in section.get("ancestors", ())
            for path in candidates:
                read = {"field": field, "section": number, "path": list(path), "take": "every" if every else "first", "near": near}
                if name == "link":
                    reads.append({**read, "attr": "href", "min_chars": 0})
                    if rule in ("dated_articles", "legacy_links", "front_page"):
                        reads.append({**read, "field": "title", **_LINK_TEXT})
                    continue
                if name == "other_title" and path == candidates[0]:
                    link = section["fields"]["link"][0]
                    reads.append({"field": "title", "section": number, "path": list(link), "attr": "data-cta-copy"})
                form = _LINK_TEXT if name == "other_title" else _FORMS.get(rule, {}).get(field, {})
                if rule == "front_page" and field == "date" and every:
                    read["take"] = "last"
                reads.append({**read, **form})
    if rule == "research_cards":
        reads.append({"field": "title", "form": "collapsed", "min_chars": 5})
        reads.append({"field": "category", "attr": "href", "pattern": "/news/", "value": "News"})
    if rule == "dyn_items":
        reads.append({"field": "date", "form": "joined", "pattern": f"({dates.LONG_DATE})"})
        reads.append({"field": "category", "attr": "data-category"})
    if rule == "dated_articles":
        path = list(LAYOUTS[rule][0]["fields"]["link"][0])
        reads.append({"field": "date", "path": path, "attr": "href", "pattern": r"/(\d{4}-\d{2}-\d{2})_"})
    return reads


def _detail(kind: str | None) -> str | None:
    if kind is None:
        return None
    sections = [{k: s.get(k) for k in ("items", "first", "fallback")} for s in DETAIL_LAYOUTS[kind]]
    reads = {
        "date": [{"field": "date", "path": ["p"]}],
        "paragraphs": [
            {"field": "description", "section": 0, "path": ["p"], "take": "every", "form": "spaced"},
            {"field": "description", "section": 1, "form": "spaced"},
        ],
        "meta": [{"field": "description", "attr": "content"}],
    }
    return program(sections, reads[kind])


# Hrefs of the listing pages themselves.
_LISTINGS = {"news_cards": "/news/?$|/news#", "research_cards": "^/research$|/research/$", "dyn_items": "/blog/category/"}
_TIDY = {"time_articles": "query", "front_page": "slashes"}
_DEFAULT_CATEGORY = {"news_cards": "News", "research_cards": "Research"}


def builtin_rules(spark: SparkSession) -> DataFrame:
    """The rules of the known sites that read listing pages, as rows."""
    rows = []
    for rule, layout in LAYOUTS.items():
        policy = POLICIES[rule]
        sections = [{k: s.get(k) for k in ("items", "first", "fallback")} for s in layout]
        options = [
            name
            for name, wanted in {
                "blank_href": rule in ("time_articles", "legacy_links", "front_page"),
                "unescape": policy.unescape,
                "squeeze": rule in ("dated_articles", "time_articles"),
                "strip_title": rule == "front_page",
                "undated": rule == "dyn_items",
            }.items()
            if wanted
        ]
        patterns = [*DATE_PATTERNS.get(rule, ())]
        if rule == "dated_articles":
            patterns.append("yyyy-MM-dd")
        rows.append(
            (
                rule, BASE_URLS[rule], policy.url_mode, _TIDY.get(rule), _LISTINGS.get(rule), int(rule == "legacy_links"),
                policy.dedupe, policy.validate, _DEFAULT_CATEGORY.get(rule), patterns, options,
                program(sections, _reads(rule)), _detail(policy.detail),
            )
        )
    return rule_rows(spark, rows)


def json_rule(spark: SparkSession) -> DataFrame:
    """What entries of JSON listings need of a rule: their detail pages."""
    policy = POLICIES["json_listing"]
    row = ("json_listing", *[None] * 5, policy.dedupe, policy.validate, None, [*DATE_PATTERNS["json_listing"]], [], None, _detail(policy.detail))
    return rule_rows(spark, [row])


# --- rules at work ----------------------------------------------------------------------------


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages with the row of their rule and the shapes of its dates; a page's own ``base_url`` wins. Pages of unknown rules go."""
    own = pages.withColumnRenamed("base_url", "own_base") if "base_url" in pages.columns else pages
    spread = [c for c in ("url", "feed_name", "page_no") if c in own.columns]
    joined = join_dimension(own, with_shapes(rules), ["rule_id"], spread_by=spread)
    if "base_url" in pages.columns:
        joined = joined.withColumn("base_url", F.coalesce("own_base", "base_url")).drop("own_base")
    return joined


def _link(href: Column) -> Column:
    full = F.lit(None)
    for mode in URL_MODES:
        full = F.when(F.col("url_mode") == mode, urls.absolute_url(href, F.col("base_url"), mode)).otherwise(full)
    tidy = F.coalesce("tidy", F.lit(""))
    return F.when(tidy == "query", urls.canonical_url(full)).when(tidy == "slashes", urls.strip_slashes(full)).otherwise(full)


def option(name: str) -> Column:
    return F.coalesce(F.array_contains("options", name), F.lit(False))


#: Patterns and listing hrefs of the known sites. As constants, Spark reads each of them once and not for every text.
_KNOWN_DATES = sorted({p for patterns in DATE_PATTERNS.values() for p in patterns} | {"yyyy-MM-dd"})


def _by_constant(value: Column, known: Collection[str], result: Callable[[Column], Column]) -> Column:
    """``result(value)``, where a value that is one of ``known`` is a constant to ``result``."""
    (first, *others) = known
    chosen = F.when(value == first, result(F.lit(first)))
    for constant in others:
        chosen = chosen.when(value == constant, result(F.lit(constant)))
    return chosen.otherwise(result(value))


def is_listing(href: Column, listing: Column) -> Column:
    """Whether an href is that of a listing page under the row's own rule."""
    return F.coalesce(_by_constant(listing, _LISTINGS.values(), lambda pattern: F.rlike(href, pattern)), F.lit(False))


def with_shapes(rules: DataFrame) -> DataFrame:
    """Rules with ``date_forms``, their date patterns, each with its shape, worked out once per rule.

    ``date_shape`` is what all of these fit, where some are not those of known sites.
    """
    shaped = F.transform("date_patterns", lambda p: F.struct(p.alias("pattern"), dates.shape_of(p).alias("shape")))
    anything = F.concat(F.lit("(?i)"), F.array_join(F.transform(shaped, lambda d: F.concat(F.lit("(?:"), d["shape"], F.lit(")"))), "|"))
    unknown = F.exists("date_patterns", lambda p: ~p.isin(_KNOWN_DATES))
    return rules.withColumns({"date_forms": shaped, "date_shape": F.when(unknown, anything)})


def first_of_patterns(texts: Column, forms: Column, shape: Column) -> Column:
    """The first text that one of the row's own date patterns fits, as a UTC wall-clock time.

    ``forms`` and ``shape`` are those of ``with_shapes``. Most texts are no dates: one look at ``shape``, or at each known
    pattern's shape, passes over them. Nothing is tried after the first date.
    """
    none = F.lit(None).cast("timestamp")

    def tried(clean: Column) -> Column:
        read = lambda fits, pattern: F.when(F.rlike(clean, fits), F.call_function("try_to_timestamp", clean, pattern))

        def fits(form: Column) -> Column:
            known = F.when(F.lit(False), none)
            for pattern in _KNOWN_DATES:
                known = known.when(form["pattern"] == pattern, read(F.lit(dates._shape(pattern)), F.lit(pattern)))
            return known.otherwise(read(form["shape"], form["pattern"]))

        return F.when(shape.isNull() | F.rlike(clean, shape), F.aggregate(forms, none, lambda found, form: F.coalesce(found, fits(form))))

    found = F.aggregate(texts, none, lambda found, t: F.coalesce(found, text.bind(text.collapse_space(t), tried)))
    return found.cast("timestamp_ntz")


def read_listing(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The items of pages that carry their rule: ``keep``, href, section, pos, link, title, description, category, published."""
    used = ("base_url", "url_mode", "tidy", "listing", "place", "default_category", "options", "date_forms", "date_shape", *POLICY)
    kept = [*keep, *[c for c in used if c not in keep]]
    walked = pages.select(*kept, F.inline(markup.read_items(F.col("html"), F.col("program"))))
    walked = walked.withColumnRenamed("link", "href")
    return walked.select(
        *keep,
        *POLICY,
        "options",
        "listing",
        "href",
        (F.col("section") + F.coalesce("place", F.lit(0))).alias("section"),
        "pos",
        _link(F.col("href")).cast("string").alias("link"),
        "title",
        "description",
        F.coalesce("category", "default_category").alias("category"),
        first_of_patterns(F.col("dates"), F.col("date_forms"), F.col("date_shape")).alias("published"),
    )
