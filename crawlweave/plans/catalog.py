"""All registered queries."""

from crawlweave.plans import archive_queries, join_queries, log_queries, page_queries, stream_queries, text_queries  # noqa: F401
from crawlweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
