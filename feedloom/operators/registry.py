"""Which feeds exist, which run, and how the run went."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.ordering import number_rows

# Ways of fetching a page.
REQUESTS = "requests"
SELENIUM = "selenium"


def feed_registry(registry: DataFrame, rules: DataFrame) -> DataFrame:
    """The registry with defaults filled in and ``problem`` telling what is wrong, if anything."""
    known = rules.select("rule_id").distinct().withColumn("_known", F.lit(True))
    problem = F.when(
        ~F.coalesce(F.col("fetch_type").isin(REQUESTS, SELENIUM), F.lit(False)), "unknown fetch type"
    ).when(F.col("_known").isNull(), "no such rule")
    return (
        registry.join(known, "rule_id", "left")
        .withColumn("enabled", F.coalesce("enabled", F.lit(True)))
        .withColumn("problem", problem)
        .select("registry_name", "feed_name", "rule_id", "fetch_type", "blog_url", "enabled", "problem")
    )


def valid_registry(registry: DataFrame, rules: DataFrame) -> DataFrame:
    return feed_registry(registry, rules).where("problem IS NULL").drop("problem")


def select_feeds(
    registry: DataFrame, skip_selenium: bool = False, selenium_only: bool = False, feed: str | None = None
) -> DataFrame:
    """Every feed with status ``selected``, ``skipped`` or ``error``, ordered by name.

    A single ``feed`` overrides the type switches; if it is unknown or disabled its status
    is ``error``. Without it, disabled feeds and feeds of the wrong type are skipped.
    """
    if skip_selenium and selenium_only:
        raise ValueError("skip_selenium and selenium_only exclude each other")
    if feed is not None:
        # A sum over no rows is still one row, so an unknown name is reported too.
        found = registry.where(F.col("registry_name") == feed).agg(
            F.max("feed_name").alias("feed_name"), F.bool_or("enabled").alias("enabled")
        )
        status = F.when(F.coalesce("enabled", F.lit(False)), "selected").otherwise("error")
        return found.select(F.lit(feed).alias("registry_name"), "feed_name", status.alias("status"))
    is_selenium = F.col("fetch_type") == SELENIUM
    wrong_type = is_selenium if skip_selenium else (~is_selenium if selenium_only else F.lit(False))
    status = F.when(~F.col("enabled") | wrong_type, "skipped").otherwise("selected")
    return registry.select("registry_name", "feed_name", status.alias("status")).orderBy("registry_name")


def run_outcomes(selection: DataFrame, entries: DataFrame) -> DataFrame:
    """What became of each feed: a selected feed without entries has failed."""
    filled = entries.groupBy("feed_name").agg(F.count(F.lit(1)).alias("n_entries"))
    status = (
        F.when(F.col("status") == "skipped", "skipped")
        .when((F.col("status") == "error") | F.col("n_entries").isNull(), "failed")
        .otherwise("successful")
    )
    return selection.join(filled, "feed_name", "left").select(
        "registry_name", "feed_name", status.alias("status")
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Feeds per outcome; the run fails when any feed failed."""
    return (
        outcomes.groupBy("status")
        .agg(F.count(F.lit(1)).alias("n_feeds"))
        .withColumn("failing", F.col("status") == "failed")
    )


def run_listing(outcomes: DataFrame) -> DataFrame:
    """The names behind the summary, sorted: rows, not one list per outcome."""
    return outcomes.select("status", "registry_name").orderBy("status", "registry_name")


def listing_positions(outcomes: DataFrame) -> DataFrame:
    """The order of ``run_listing`` as data: ``list_pos`` counts the names of each outcome from 1."""
    names = outcomes.select("status", "registry_name", "feed_name")
    order = [F.col("registry_name").asc(), F.col("feed_name").asc()]
    return number_rows(names, ["status"], order, "list_pos").drop("feed_name")
