"""One rule per kind of listing page. A rule is data; the pipeline in ``entries.py`` reads it.

Selectors and date patterns are fixed values: they must equal the markup of the sites.
"""

from __future__ import annotations

from dataclasses import dataclass

# Where the items are on a page and where each field is looked for, in order.
LAYOUTS = {
    "news_cards": [
        {
            "items": "a[href*='/news/']",
            "fields": {
                "title": [
                    ("h2[class*='featuredTitle']",),
                    ("h4[class*='title']",),
                    ("span[class*='title']",),
                    ("h3.PostCard_post-heading__Ob1pu",),
                    ("h3.Card_headline__reaoT",),
                    ("h3[class*='headline']",),
                    ("h3[class*='heading']",),
                    ("h2[class*='headline']",),
                    ("h2[class*='heading']",),
                    ("h3",),
                    ("h2",),
                ],
                "date": [
                    ("time[class*='date']",),
                    ("time",),
                    ("p.detail-m",),
                    ("div.PostList_post-date__djrOA",),
                    ("p[class*='date']",),
                    ("div[class*='date']",),
                ],
                "category": [
                    ("span[class*='subject']",),
                    ("span.caption.bold",),
                    ("span.text-label",),
                    ("p.detail-m",),
                    ("span[class*='category']",),
                    ("div[class*='category']",),
                ],
            },
            "every": ["date"],
        }
    ],
    "research_cards": [
        {
            "items": "a[href*='/research/']",
            "fields": {
                "title": [
                    ("h3",),
                    ("h2",),
                    ("h1",),
                    (".Card_headline__reaoT",),
                    ("h3[class*='headline']",),
                    ("h2[class*='headline']",),
                    ("h3[class*='title']",),
                    ("h2[class*='title']",),
                ],
                "date": [
                    ("p.detail-m",),
                    (".detail-m",),
                    ("time",),
                    ("[class*='timestamp']",),
                    ("[class*='date']",),
                    (".PostDetail_post-timestamp__TBJ0Z",),
                    (".text-label",),
                ],
            },
            "ancestors": ["date"],
        }
    ],
    "note_links": [
        {
            "items": "a.note",
            "fields": {"title": [("h3",)], "description": [("div.description",)]},
        }
    ],
    "dyn_items": [
        {
            "items": ".w-dyn-item",
            "fields": {
                "link": [("a[href^='/blog/']",)],
                "title": [("h2",)],
                "other_title": [("h3",), ("h4",), (".u-text-style-h6",)],
                "category": [("[fs-list-field='category']",)],
                "description": [(".card_blog_description, .u-text-style-body-2, p",)],
            },
        }
    ],
    "dated_articles": [
        {
            "items": "div#content article",
            "fields": {
                "link": [("h1", "a[href]")],
                "date": [("p.date",)],
                "description": [("div.summary", "p")],
            },
            "every": ["description"],
        }
    ],
    "legacy_links": [
        {"items": "div.blogentry", "fields": {"link": [("a[href]",)]}},
    ],
    "time_articles": [
        {
            "items": "article",
            "fields": {
                "link": [("a[href]",)],
                "title": [("h1, h2, h3",)],
                "date": [("time",)],
                "description": [("p",)],
            },
            "every": ["description"],
        }
    ],
    "front_page": [
        {
            "items": "article.mp-hero__lead",
            "first": True,
            "fields": {
                "link": [("h1.mp-hero__title a[href]",)],
                "date": [("div.mp-hero__byline", "span")],
                "category": [("a.mp-cat",)],
            },
            "every": ["date"],
        },
        {
            "items": "li.mp-sidecar__item",
            "fields": {
                "link": [("h3.mp-sidecar__title a[href]",)],
                "date": [("div.mp-meta",)],
                "category": [("a.mp-cat",)],
            },
        },
        {
            "items": "article.mp-card",
            "fields": {
                "link": [("h3.mp-card__title a[href]",)],
                "date": [("div.mp-meta--mt",)],
                "category": [("a.mp-cat",)],
            },
        },
    ],
}

# Where detail pages keep the date or the first paragraphs.
DETAIL_LAYOUTS = {
    "date": [{"items": "d-article", "first": True, "fields": {"date": [("p",)]}}],
    "paragraphs": [
        {"items": "div#blogcontent", "first": True, "fields": {"description": [("p",)]}, "every": ["description"]},
        {"items": "p", "fallback": True, "fields": {}},
    ],
    "meta": [{"items": "meta[name='description']", "first": True, "fields": {}}],
}

# Date patterns in the order they are tried.
DATE_PATTERNS = {
    "news_cards": ["MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy-M-d", "M/d/yyyy"],
    "research_cards": [
        "MMM d, yyyy",
        "MMMM d, yyyy",
        "yyyy-M-d",
        "M/d/yyyy",
        "d MMM yyyy",
        "d MMMM yyyy",
        "MMM d yyyy",
        "MMMM d yyyy",
    ],
    "note_links": ["MMMM d, yyyy", "MMM d, yyyy", "MMMM yyyy", "MMM yyyy"],
    "embedded_json": ["yyyy-M-d"],
    "dyn_items": ["MMMM d, yyyy"],
    "dated_articles": ["MMMM d, yyyy", "MMM d, yyyy"],
    "json_listing": ["yyyy-M-d"],
    "time_articles": ["MMM d, yyyy", "MMMM d, yyyy"],
    "front_page": ["MMMM d, yyyy"],
}


@dataclass(frozen=True)
class Policy:
    """What the pipeline does with the candidates of a rule."""

    dedupe: str  # first_valid, first_seen, first_dated or none
    url_mode: str = "prefix"
    validate: str = "non_blank"  # non_blank, strict, lax or titled
    detail: str | None = None  # date, paragraphs or meta
    unescape: bool = False


POLICIES = {
    "news_cards": Policy("first_seen", "prefix_rooted", "strict"),
    "research_cards": Policy("first_seen", "https_or_rooted", "lax"),
    "note_links": Policy("first_seen", "rooted_or_bare", "titled", detail="date"),
    "embedded_json": Policy("none", "prefix", "strict"),
    "dyn_items": Policy("first_dated", "prefix", "non_blank", unescape=True),
    "dated_articles": Policy("first_valid", "prefix", "non_blank", unescape=True),
    "json_listing": Policy("first_valid", "strip_slash", "non_blank", detail="paragraphs"),
    "legacy_links": Policy("first_valid", "strip_slash", "non_blank", detail="paragraphs", unescape=True),
    "time_articles": Policy("first_valid", "prefix", "non_blank", unescape=True),
    "front_page": Policy("first_valid", "prefix", "non_blank", detail="meta", unescape=True),
}
