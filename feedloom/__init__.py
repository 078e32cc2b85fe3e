"""Feed analytics on Spark: from page snapshots to clean, ordered, audited feeds."""
