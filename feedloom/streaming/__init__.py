"""Incremental refresh as a stream."""
