"""Queries over the given tables, each with the SQL that must give the same rows."""

from paperfield.catalog.registry import ORACLES, QUERIES
from paperfield.catalog import bodies, content, crawl, discovery, queues, streams, urls  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
