"""URL clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)


def absolute_url(href: Column, base: str | Column, mode: str = "prefix") -> Column:
    """Turn an href into a full URL.

    prefix           anything not starting with ``http`` gets the base in front
    strip_slash      the same, with exactly one slash between base and path
    rooted_or_bare   base in front; a bare name gets a slash too
    prefix_rooted    base in front of ``/...``; everything else stays as it is
    https_or_rooted  ``https://`` stays, ``/...`` gets the base, the rest is NULL
    """
    base = base if isinstance(base, Column) else F.lit(base)
    is_http = F.startswith(href, F.lit("http"))
    is_rooted = F.startswith(href, F.lit("/"))
    joined = F.concat(base, href)
    if mode == "prefix":
        return F.when(is_http, href).otherwise(joined)
    if mode == "strip_slash":
        bare = F.ltrim(href, F.lit("/"))
        return F.when(is_http, href).otherwise(F.concat(base, F.lit("/"), bare))
    if mode == "rooted_or_bare":
        bare = F.concat(base, F.lit("/"), href)
        return F.when(is_http, href).when(is_rooted, joined).otherwise(bare)
    if mode == "prefix_rooted":
        return F.when(is_rooted, joined).otherwise(href)
    if mode == "https_or_rooted":
        return F.when(F.startswith(href, F.lit("https://")), href).when(is_rooted, joined)
    raise ValueError(f"unknown URL mode: {mode}")


def canonical_url(url: Column) -> Column:
    """Cut the query, then the slashes at the end."""
    return strip_slashes(F.substring_index(url, "?", 1))


def strip_slashes(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def is_index_page(link: Column, section: str) -> Column:
    """The listing page itself (``/news``, ``/news/``) or an anchor on it (``/news#x``)."""
    return (
        F.endswith(link, F.lit(f"/{section}"))
        | F.endswith(link, F.lit(f"/{section}/"))
        | F.contains(link, F.lit(f"/{section}#"))
    )
