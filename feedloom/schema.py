"""Fixed schemas. Dates are TIMESTAMP_NTZ holding UTC; ``seq`` is the order of arrival."""

ENTRY = (
    "feed_name STRING, link STRING, title STRING, description STRING, "
    "category STRING, published TIMESTAMP_NTZ, seq BIGINT"
)
ENTRY_COLUMNS = ["feed_name", "link", "title", "description", "category", "published", "seq"]

REGISTRY = (
    "registry_name STRING, feed_name STRING, rule_id STRING, "
    "fetch_type STRING, blog_url STRING, enabled BOOLEAN"
)

CHANNEL = (
    "feed_name STRING, title STRING, description STRING, subtitle STRING, "
    "language STRING, author STRING, logo STRING, blog_url STRING"
)

STORE_DOCUMENT = (
    "last_updated STRING, entries ARRAY<STRUCT<title: STRING, link: STRING, "
    "date: STRING, category: STRING, description: STRING>>, _corrupt_record STRING"
)

FEED_DOCUMENT = (
    "channel STRUCT<title: STRING, link: STRING, description: STRING, language: STRING, "
    "lastBuildDate: STRING, item: ARRAY<STRUCT<title: STRING, link: STRING, "
    "description: STRING, guid: STRING, category: STRING, pubDate: STRING>>>, "
    "_corrupt_record STRING"
)

LISTING_ROW = "ARRAY<STRUCT<date: STRING, s3Key: STRING, title: STRING>>"
