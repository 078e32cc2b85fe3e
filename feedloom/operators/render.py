"""Feed documents (RSS 2.0) as text columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import as_of, format_rfc822
from feedloom.functions.text import escape_xml, sanitize_xml
from feedloom.operators.joins import join_dimension
from feedloom.operators.lifecycle import NOTICE_PREFIX

GENERATOR = "feedloom"

# A feed with more items than this continues in further well-formed documents.
ITEMS_PER_DOCUMENT = 10_000

# Opening and closing of a document.
OPENING = (
    "<?xml version='1.0' encoding='UTF-8'?>\n"
    '<rss xmlns:atom="http://www.w3.org/2005/Atom" '
    'xmlns:content="http://purl.org/rss/1.0/modules/content/" version="2.0">\n'
    "  <channel>\n"
)
CLOSING = "  </channel>\n</rss>"
DOCS = "http://www.rssboard.org/rss-specification"
OPENSEARCH = "http://a9.com/-/spec/opensearch/1.1/"


def _element(name: str, value: Column, indent: int, attributes: str = "") -> Column:
    """``<name>value</name>`` on a line of its own; nothing when the value is NULL."""
    clean = escape_xml(sanitize_xml(value))
    line = F.concat(F.lit(f"{' ' * indent}<{name}{attributes}>"), clean, F.lit(f"</{name}>\n"))
    return F.coalesce(line, F.lit(""))


def item_xml() -> Column:
    """One item. A retirement notice has the element order notices are written in."""
    title = _element("title", F.col("title"), 6)
    link = _element("link", F.col("link"), 6)
    description = _element("description", F.col("description"), 6)
    guid = _element("guid", F.col("guid"), 6, ' isPermaLink="false"')
    category = _element("category", F.col("category"), 6)
    date = _element("pubDate", format_rfc822(F.col("published")), 6)
    usual = F.concat(title, link, description, guid, category, date)
    notice = F.concat(title, description, guid, date, link)
    body = F.when(F.startswith("guid", F.lit(NOTICE_PREFIX)), notice).otherwise(usual)
    return F.concat(F.lit("    <item>\n"), body, F.lit("    </item>\n"))


def feed_items(entries: DataFrame) -> DataFrame:
    """Ordered entries (with ``feed_pos``) as items; the guid is the link."""
    return entries.select(
        "feed_name", "feed_pos", "title", "link", "description", F.col("link").alias("guid"), "category", "published"
    )


def render_items(items: DataFrame) -> DataFrame:
    return items.select("feed_name", "feed_pos", item_xml().alias("item_xml"))


def channel_xml(feed_url: Column, built: Column) -> Column:
    """Everything of the channel in front of the items. The description is the subtitle.

    The author is part of the channel row, but RSS has no place for a name without an
    address, so it is not written.
    """
    blog = F.col("blog_url")
    image = F.concat(
        F.lit("    <image>\n"),
        _element("url", F.col("logo"), 6),
        _element("title", F.col("title"), 6),
        _element("link", blog, 6),
        F.lit("    </image>\n"),
    )
    self_link = F.concat(F.lit('    <atom:link href="'), escape_xml(feed_url), F.lit('" rel="self"/>\n'))
    return F.concat(
        F.lit(OPENING),
        _element("title", F.col("title"), 4),
        _element("link", blog, 4),
        _element("description", F.coalesce("subtitle", "description"), 4),
        self_link,
        _element("docs", F.lit(DOCS), 4),
        _element("generator", F.lit(GENERATOR), 4),
        F.when(F.col("logo").isNotNull(), image).otherwise(F.lit("")),
        _element("language", F.col("language"), 4),
        _element("lastBuildDate", format_rfc822(built), 4),
    )


def document_address(feed_base_url: str, part: Column) -> Column:
    """Where a part of a feed stands: ``feed_<name>.xml``, further parts in a folder of that name.

    A feed name holds no slash, so no feed's first document can have the address of another one's part.
    """
    stem = F.concat(F.lit(feed_base_url.rstrip("/") + "/feed_"), F.col("feed_name"))
    further = F.concat(stem, F.lit("/"), part.cast("string"), F.lit(".xml"))
    return F.when(part > 0, further).otherwise(F.concat(stem, F.lit(".xml")))


def _page_link(relation: str, address: Column) -> Column:
    line = F.concat(F.lit('    <atom:link href="'), escape_xml(address), F.lit(f'" rel="{relation}"/>\n'))
    return F.coalesce(line, F.lit(""))


def render_feeds(
    items: DataFrame,
    channels: DataFrame,
    built_at: str | datetime,
    feed_base_url: str,
    items_per_document: int = ITEMS_PER_DOCUMENT,
) -> DataFrame:
    """One document per feed and part: feed_name, part, rss_xml.

    Items are gathered per feed *and* part, never more than ``items_per_document`` at once,
    so no feed has to fit into one task. Nearly every feed has part 0 only. Parts are pages of one paged feed:
    each links to the next and the previous one, so that a reader of the first reaches every item, and says
    at which position its items start. Positions of a feed count from 1 without gaps; a notice may stand at 0.
    """
    at = F.col("feed_pos")
    # A notice in front of the first item has position 0 and belongs to part 0.
    part = F.greatest(F.floor((at - 1) / items_per_document), F.lit(0)).cast("int")
    lines = items.select("feed_name", part.alias("_part"), "feed_pos", item_xml().alias("item_xml"))
    # The first item of a part tells the part before it that there is a next one.
    own = F.struct(F.col("_part").alias("part"), F.lit(False).alias("next"))
    told = F.struct((F.col("_part") - 1).alias("part"), F.lit(True).alias("next"))
    opens = (F.col("_part") > 0) & ((at - 1) % items_per_document == 0)
    lines = lines.select("feed_name", "feed_pos", "item_xml", F.inline(F.when(opens, F.array(own, told)).otherwise(F.array(own))))
    held = F.when(~F.col("next"), F.struct("feed_pos", "item_xml"))
    bodies = lines.groupBy("feed_name", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(held)), lambda i: i["item_xml"]), "").alias("body"),
        F.bool_or("next").alias("_next"),
    )
    # A feed without a channel row still gets its document, under its own name.
    rows = join_dimension(bodies, channels.drop("author"), ["feed_name"], "left", spread_by=["part"])
    named = rows.withColumn("title", F.coalesce("title", "feed_name"))
    part = F.col("part")
    start = F.concat(
        F.lit(f'    <opensearch:startIndex xmlns:opensearch="{OPENSEARCH}">'),
        (part.cast("bigint") * items_per_document + 1).cast("string"),
        F.lit("</opensearch:startIndex>\n"),
    )
    pages = F.concat(
        _page_link("previous", F.when(part > 0, document_address(feed_base_url, part - 1))),
        _page_link("next", F.when(F.col("_next"), document_address(feed_base_url, part + 1))),
        F.when(part > 0, start).otherwise(F.lit("")),
    )
    head = channel_xml(document_address(feed_base_url, part), as_of(built_at))
    document = F.concat(head, pages, "body", F.lit(CLOSING))
    return named.select("feed_name", "part", document.alias("rss_xml"))
