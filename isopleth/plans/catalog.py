"""All registered queries."""

from isopleth.plans import field_queries, series_queries  # noqa: F401
from isopleth.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
