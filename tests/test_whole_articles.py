"""Articles are read whole: far titles, and neighbours without one."""

from feedloom.operators.extract import embedded_articles


def article(slug, *fields):
    pairs = "".join(f',\\"{k}\\":\\"{v}\\"' for k, v in fields)
    return rf'{{\"publishedOn\":\"2025-01-02\",\"slug\":{{\"_type\":\"slug\",\"current\":\"{slug}\"}},\"type\":\"engineeringArticle\"{pairs}}}'


def test_articles_are_read_to_the_next_one(spark):
    script = article("far-away", ("body", "x" * 5000), ("summary", "S"), ("title", "Far")) + article("no-title") + article("near", ("title", "Near"))
    pages = spark.createDataFrame([(f"<script>{script}</script>",)], "html string")
    got = [(r.link, r.title, r.description) for r in embedded_articles(pages, "").orderBy("pos").collect()]
    assert got == [("far-away", "Far", "S"), ("no-title", "No Title", "No Title"), ("near", "Near", "Near")]
    short = embedded_articles(pages, "", reach=2000).orderBy("pos").collect()
    assert [r.title for r in short] == ["Far Away", "No Title", "Near"]
