"""What makes an entry acceptable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shortest title the strict checks accept.
MIN_TITLE = 5


def valid_entry(
    title: Column | str = "title",
    link: Column | str = "link",
    published: Column | str = "published",
    require_date: bool = True,
) -> Column:
    """Title of five characters or more, an http link and (strict form) a date."""
    title, link, published = (F.col(c) if isinstance(c, str) else c for c in (title, link, published))
    ok = (F.length(title) >= MIN_TITLE) & F.startswith(link, F.lit("http"))
    if require_date:
        ok = ok & published.isNotNull()
    return F.coalesce(ok, F.lit(False))


def non_blank(title: Column | str = "title", link: Column | str = "link") -> Column:
    """Title and link are there and not blank."""
    title, link = (F.col(c) if isinstance(c, str) else c for c in (title, link))
    return F.coalesce((title != "") & (link != ""), F.lit(False))
