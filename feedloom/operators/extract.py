"""Extraction from pages: flat patterns in the JVM, nodes through the HTML walk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import markup
from feedloom.functions.dates import fallback_date, parse_date
from feedloom.functions.text import (
    collapse_space,
    description_or_title,
    null_if_blank,
    slug_title,
    strip,
    unescape_attributes,
    unescape_backslash,
    unescape_html,
)
from feedloom.functions.urls import absolute_url
from feedloom.schema import LISTING_ROW

# What marks the script with the articles, and the pairs inside it.
ARTICLE_MARKS = ("publishedOn", "engineeringArticle")
ARTICLE_PAIR = r'\\"publishedOn\\":\\"([^"]+?)\\",\\"slug\\":\{[^}]*?\\"current\\":\\"([^"]+?)\\"'
ARTICLE_TITLE = r'\\"title\\":\\"(.*?)(?<!\\)\\"'
ARTICLE_SUMMARY = r'\\"summary\\":\\"(.*?)(?<!\\)\\"'
ARTICLE_START = '\\"publishedOn\\":'

# Fixed value: a paging link such as ``?1a2b3c_page=2``.
PAGING_ID = r"\?([a-f0-9]+)_page=\d+"


# One step of the scan: a comment, a script or style with its content, an anchor's attributes (the group), or
# another tag. Quoted values may hold any character, so nothing inside them opens a tag.
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
SCAN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<(?:script|style)\b{_ATTRIBUTES}>.*?(?:</(?:script|style)\s*>|\z)"
    rf"|<a(?=[\s/])({_ATTRIBUTES})>"
    rf"|</?[a-z]{_ATTRIBUTES}>"
)
ATTRIBUTE = r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?"""


def _href(attributes: Column) -> Column:
    """The value of the first ``href`` of a tag, without its quotes; NULL if there is none."""
    names = F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), F.lit(1))
    values = F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), F.lit(2))
    at = F.array_position(F.transform(names, F.lower), F.lit("href")).cast("int")
    value = F.get(values, at - 1)
    quoted = F.rlike(value, F.lit("""^["']"""))
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def extract_links(pages: DataFrame, contains: str = "", base: str | Column | None = None, mode: str = "prefix"):
    """Anchor hrefs holding ``contains``, with their position on the page.

    A page is scanned once in the JVM. Links in comments, scripts, styles and attribute values do not count.
    Values stand in double, single or no quotes; their entities are decoded, and only pages with unusual
    entities take a step in Python for it.
    """
    anchors = F.filter(F.regexp_extract_all("html", F.lit(SCAN), F.lit(1)), lambda a: a != "")
    hrefs = unescape_attributes(F.filter(F.transform(anchors, _href), lambda h: h != ""))
    wanted = F.filter(hrefs, lambda h: (h != "") & F.contains(h, F.lit(contains)))
    rest = [c for c in pages.columns if c != "html"]
    links = pages.select(*rest, F.posexplode(wanted).alias("pos", "href"))
    if base is None:
        return links
    return links.withColumn("link", absolute_url(F.col("href"), base, mode)).where("link IS NOT NULL")


def select_nodes(pages: DataFrame, selectors: Mapping[str, str]) -> DataFrame:
    """One row per node that matches one of the named selectors, in document order."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.inline(markup.select_nodes(F.col("html"), selectors)))


def meta_description(html: Column) -> Column:
    """Content of ``<meta name="description">``, cleaned; blank when there is none.

    Decoded twice: once as an attribute, once as text that was escaped before.
    """
    tags = F.regexp_extract_all(html, F.lit(r"(?i)(<meta\b[^>]*>)"), F.lit(1))
    named = F.filter(tags, lambda t: F.rlike(t, F.lit(r"""(?i)\sname=["']?description["'\s/>]""")))
    tag = F.coalesce(F.get(named, F.lit(0)), F.lit(""))
    double = F.regexp_extract(tag, r'(?i)\scontent="([^"]*)"', 1)
    single = F.regexp_extract(tag, r"(?i)\scontent='([^']*)'", 1)
    content = F.coalesce(null_if_blank(double), single)
    return collapse_space(unescape_html(unescape_html(content)))


def pagination_ids(pages: DataFrame) -> DataFrame:
    """Distinct paging ids named on the pages of each feed."""
    ids = F.regexp_extract_all("html", F.lit(PAGING_ID), F.lit(1))
    return pages.select("feed_name", F.explode(F.array_distinct(ids)).alias("collection_id")).distinct()


def date_sections(pages: DataFrame, patterns: list[str]) -> DataFrame:
    """Distinct date dividers (``div.date``) of each feed that name a real date."""
    dividers = select_nodes(pages.select("feed_name", "html"), {"date": "div.date"})
    text = markup.node_text(F.struct("strings"))
    return (
        dividers.select("feed_name", text.alias("date_text"))
        .distinct()
        .withColumn("published", parse_date(F.col("date_text"), patterns))
        .where("published IS NOT NULL")
    )


def embedded_articles(
    pages: DataFrame, base: str | Column, category: str = "Engineering", reach: int | None = None
) -> DataFrame:
    """Articles from escaped JSON inside the first script that holds both marks.

    Title and summary are looked up from the first place the slug stands at to the start of the
    next article, or in ``reach`` characters at most if that is given. They are cut out as an
    array before the rows multiply, so the script itself is never copied. Rows are neither checked
    nor de-duplicated here.
    """
    base = base if isinstance(base, Column) else F.lit(base)
    scripts = F.regexp_extract_all("html", F.lit(r"(?is)<script\b[^>]*>(.*?)</script"), F.lit(1))
    marked = F.filter(scripts, lambda s: F.contains(s, F.lit(ARTICLE_MARKS[0])) & F.contains(s, F.lit(ARTICLE_MARKS[1])))
    rest = [c for c in pages.columns if c != "html"]
    found = pages.select(*rest, F.get(marked, F.lit(0)).alias("_script")).where("_script IS NOT NULL")

    script = F.col("_script")
    found = found.withColumns(
        {
            "_date": F.regexp_extract_all(script, F.lit(ARTICLE_PAIR), F.lit(1)),
            "_slug": F.regexp_extract_all(script, F.lit(ARTICLE_PAIR), F.lit(2)),
        }
    )
    at = lambda slug: F.position(F.concat(F.lit('\\"current\\":\\"'), slug, F.lit('\\"')), script)

    def section_of(slug):
        start = at(slug)
        following = F.position(F.lit(ARTICLE_START), script, start)
        size = F.when(following > 0, following).otherwise(F.length(script) + 1) - start
        return F.substring(script, start, size if reach is None else F.least(size, F.lit(reach)))

    near = F.transform("_slug", section_of)
    rows = found.select(*rest, F.posexplode(F.arrays_zip("_date", "_slug", near.alias("_near"))).alias("pos", "_a"))

    section, slug = F.col("_a._near"), F.col("_a._slug")
    has_title = F.rlike(section, F.lit(ARTICLE_TITLE))
    title = F.when(has_title, F.regexp_extract(section, ARTICLE_TITLE, 1)).otherwise(slug_title(slug))
    title = unescape_backslash(title)
    summary = unescape_backslash(F.regexp_extract(section, ARTICLE_SUMMARY, 1))
    return rows.select(
        *rest,
        "pos",
        F.concat(base, slug).alias("link"),
        title.alias("title"),
        description_or_title(summary, title).alias("description"),
        F.lit(category).alias("category"),
        parse_date(F.col("_a._date"), ["yyyy-M-d"]).alias("published"),
    )


def json_listing(bodies: DataFrame, base: str | Column) -> DataFrame:
    """Entries from a JSON array of ``{date, s3Key, title}``; rows without key or title go."""
    rest = [c for c in bodies.columns if c != "body"]
    rows = bodies.select(*rest, F.posexplode(F.from_json("body", LISTING_ROW)).alias("pos", "_r"))
    rows = rows.where("_r.s3Key <> '' AND _r.title <> ''")
    link = absolute_url(F.col("_r.s3Key"), base, "strip_slash")
    return rows.select(
        *rest,
        "pos",
        link.alias("link"),
        strip(unescape_html(F.col("_r.title"))).alias("title"),
        F.coalesce(parse_date(F.col("_r.date"), ["yyyy-M-d"]), fallback_date(link)).alias("published"),
    ).where("title <> ''")
