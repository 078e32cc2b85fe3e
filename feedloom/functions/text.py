"""Text clean-up as column expressions (all JVM side but the full entity decoding)."""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship the Python helpers with the job, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Everything Unicode and Python call white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Control characters that XML 1.0 refuses, plus 0x7f-0x9f.
ILLEGAL_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"

# A text holding one of these is taken for a date.
MONTH_MARKS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` names it.

    Spark shares repeated expressions of a projection, but not those inside the branches of
    a CASE or inside a lambda, where the long chains of these functions live.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Cut white space of any kind from both ends (linear, no regular expression)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def collapse_space(text: Column) -> Column:
    """Each run of white space becomes one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1C-\x1F]+", " "))


def sanitize_xml(text: Column) -> Column:
    """Drop characters XML 1.0 cannot hold; tab, line feed and carriage return stay."""
    return F.regexp_replace(text, ILLEGAL_XML, "")


def escape_xml(text: Column) -> Column:
    """Element text: ``&`` first, then the angle brackets."""
    amp = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(amp, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


# The everyday entities; ``&amp;`` goes last, so that nothing is decoded twice.
EVERYDAY = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\xa0"),
    ("&copy;", "\xa9"),
    ("&middot;", "\xb7"),
    ("&amp;", "&"),
]


def unescape_common(text: Column) -> Column:
    """Decode the everyday entities without leaving the JVM; ``&amp;`` goes last."""
    for entity, plain in EVERYDAY:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def _decoded(text: str) -> str:
    """``html.unescape``, faster where every ``&`` begins an everyday entity."""
    left = text.count("&")
    held = []
    for entity, plain in reversed(EVERYDAY):
        if left and (found := text.count(entity)):
            held.append((entity, plain))
            left -= found
    if left:
        return html.unescape(text)
    for entity, plain in reversed(held):
        text = text.replace(entity, plain)
    return text


def _unescape_batch(batch: pa.Array) -> pa.Array:
    return pa.array([_decoded(v) if v and "&" in v else v for v in batch.to_pylist()], type=pa.string())


def unescape_html(text: Column) -> Column:
    """Decode every HTML5 entity. Spark has no built-in for it, so this is an Arrow function."""
    return F.arrow_udf(_unescape_batch, "string")(text)


ENTITY = re.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def _unescape_arrays(batch: pa.Array) -> pa.Array:
    def decoded(values):
        return None if values is None else [ENTITY.sub(lambda m: html.unescape(m[0]), v) for v in values]

    return pa.array([decoded(v) for v in batch.to_pylist()], type=pa.list_(pa.string()))


def unescape_attributes(values: Column) -> Column:
    """Attribute values of one page with every entity decoded that ends in a semicolon.

    Only arrays with an entity beyond the everyday ones reach Python.
    """
    unusual = F.exists(values, lambda v: F.rlike(v, F.lit("&(?!(?:lt|gt|quot|#39|apos|nbsp|copy|middot|amp);)[#A-Za-z0-9]+;")))
    full = F.arrow_udf(_unescape_arrays, "array<string>")(F.when(unusual, values))
    return F.coalesce(full, F.transform(values, unescape_common))


def unescape_backslash(text: Column) -> Column:
    r"""Drop one backslash and keep the character after it: ``\"`` gives ``"``."""
    return F.regexp_replace(text, r"\\([^\n])", "$1")


def slug_title(slug: Column) -> Column:
    """``my-post-2b`` gives ``My Post 2B``: every run of letters is capitalised by itself."""
    spaced = F.replace(slug, F.lit("-"), F.lit(" "))
    runs = F.regexp_extract_all(spaced, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_match(texts: Column, min_len: int = 1) -> Column:
    """First text of an array with at least ``min_len`` characters."""
    return F.get(F.filter(texts, lambda t: F.length(t) >= min_len), F.lit(0))


def first_paragraph(paragraphs: Column, skip: str | None) -> Column:
    """First non-blank paragraph that is not a "read more" link.

    ``skip`` is ``"equals"`` (the whole text), ``"prefix"`` (the text starts so) or None.
    """

    def useful(p: Column) -> Column:
        if skip == "equals":
            return (p != "") & (F.lower(p) != "read more")
        if skip == "prefix":
            return (p != "") & ~F.startswith(F.lower(p), F.lit("read more"))
        return p != ""

    return F.get(F.filter(paragraphs, useful), F.lit(0))


def looks_like_date(text: Column) -> Column:
    """True when a month abbreviation occurs anywhere (case matters)."""
    return F.rlike(text, F.lit("|".join(MONTH_MARKS)))


def first_category(texts: Column, default: str | None) -> Column:
    """First text that does not look like a date; a blank one counts and is kept."""
    return F.coalesce(F.get(F.filter(texts, lambda t: ~looks_like_date(t)), F.lit(0)), F.lit(default))


def url_category(href: Column) -> Column:
    return F.when(F.contains(href, F.lit("/news/")), "News").otherwise("Research")


def description_or_title(description: Column, title: Column) -> Column:
    return F.coalesce(null_if_blank(description), title)
