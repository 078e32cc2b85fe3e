"""The sites known out of the box: registry and channel rows, as DataFrames.

All rows are fixed values. Pass your own DataFrames of the same schemas for other sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.plans.rules import POLICIES
from feedloom.schema import CHANNEL, REGISTRY

# Registry name, feed name, rule, fetch type, blog URL.
REGISTERED = [
    ("anthropic_eng", "anthropic_engineering", "embedded_json", "requests", "https://www.anthropic.com/engineering"),
    ("anthropic_news", "anthropic_news", "news_cards", "selenium", "https://www.anthropic.com/news"),
    ("anthropic_red", "anthropic_red", "note_links", "requests", "https://red.anthropic.com/"),
    ("anthropic_research", "anthropic_research", "research_cards", "selenium", "https://www.anthropic.com/research"),
    ("brettski", "brettski", "json_listing", "requests", "https://brettski.net"),
    ("claude", "claude", "dyn_items", "requests", "https://claude.com/blog"),
    ("itopfield", "itopfield", "front_page", "requests", "https://itopfield.com.au"),
    ("jamiehurst", "jamiehurst", "dated_articles", "requests", "https://jamiehurst.co.uk"),
    ("pulumi", "pulumi", "time_articles", "requests", "https://www.pulumi.com/blog/"),
]

# Fixed value: logo shared by four of the feeds.
_LOGO = "https://www.anthropic.com/images/icons/apple-touch-icon.png"

# Feed name, title, description, subtitle, language, author, logo, blog URL.
CHANNELS = [
    (
        "anthropic_engineering",
        "Anthropic Engineering Blog",
        "Latest engineering articles and insights from Anthropic's engineering team",
        "Inside the team building reliable AI systems",
        "en",
        "Anthropic Engineering Team",
        _LOGO,
        "https://www.anthropic.com/engineering",
    ),
    (
        "anthropic_news",
        "Anthropic News",
        "Latest news and updates from Anthropic",
        "Latest updates from Anthropic's newsroom",
        "en",
        "Anthropic News",
        _LOGO,
        "https://www.anthropic.com/news",
    ),
    (
        "anthropic_red",
        "Anthropic Frontier Red Team Blog",
        "Research from Anthropic's Frontier Red Team on what frontier AI models mean for national security",
        "Evidence-based analysis about AI's implications for cybersecurity, biosecurity, and autonomous systems",
        "en",
        "Anthropic Frontier Red Team",
        _LOGO,
        "https://red.anthropic.com/",
    ),
    (
        "anthropic_research",
        "Anthropic Research",
        "Latest research papers and updates from Anthropic",
        "Latest research from Anthropic",
        "en",
        "Anthropic Research Team",
        _LOGO,
        "https://www.anthropic.com/research",
    ),
    (
        "brettski",
        "Brettski's Blog",
        "Random posts on AWS, cloud engineering, Linux, and other technical adventures from Brettski.",
        "Latest posts from Brettski's Blog",
        "en",
        "Brettski",
        None,
        "https://brettski.net",
    ),
    (
        "claude",
        "Claude Blog",
        "Get practical guidance and best practices for building with Claude. Technical guides, real-world "
        "examples, and insights from Anthropic's engineering and research teams.",
        "Latest updates from Claude Blog",
        "en",
        "Anthropic",
        None,
        "https://claude.com/blog",
    ),
    (
        "itopfield",
        "ITop Field News",
        "Technology news and analysis for Australian IT professionals and businesses.",
        "Latest posts from ITop Field News",
        "en",
        "ITop Field News",
        None,
        "https://itopfield.com.au",
    ),
    (
        "jamiehurst",
        "Jamie Hurst's Blog",
        "Software and systems engineering writing from Jamie Hurst.",
        "Latest posts from Jamie Hurst's Blog",
        "en",
        "Jamie Hurst",
        None,
        "https://jamiehurst.co.uk",
    ),
    (
        "pulumi",
        "Pulumi Blog",
        "Product updates, tutorials, and announcements from the Pulumi blog (pulumi.com/blog).",
        "Latest posts from the Pulumi Blog",
        "en",
        "Pulumi",
        None,
        "https://www.pulumi.com/blog/",
    ),
]

# What each rule puts in front of a relative link.
BASE_URLS = {
    "news_cards": "https://www.anthropic.com",
    "research_cards": "https://www.anthropic.com",
    "note_links": "https://red.anthropic.com",
    "embedded_json": "https://www.anthropic.com/engineering/",
    "dyn_items": "https://claude.com",
    "dated_articles": "https://jamiehurst.co.uk",
    "json_listing": "https://brettski.net",
    "legacy_links": "https://brettski.net",
    "time_articles": "https://www.pulumi.com",
    "front_page": "https://itopfield.com.au",
}


def site_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*row, None) for row in REGISTERED], REGISTRY)


def site_channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNELS, CHANNEL)


def known_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(rule,) for rule in sorted(POLICIES)], "rule_id STRING")
