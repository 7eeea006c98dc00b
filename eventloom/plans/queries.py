"""All registered queries of the library (those of the corpus operators apart)."""

from eventloom.plans import chip_queries, file_queries, match_queries, report_queries, stats_queries, stream_queries  # noqa: F401  (they register themselves)
from eventloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
