"""The query catalogue. Importing it registers every query."""

from ratelake.queries import analytics, series, tables
from ratelake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analytics", "series", "tables"]
