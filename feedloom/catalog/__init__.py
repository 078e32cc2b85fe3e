"""Every operator as a named query over the supplied tables, with its SQL where SQL can say it."""

from feedloom.catalog import basics, crawling, keeping, publishing, sites  # noqa: F401
from feedloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
