"""All registered queries; importing the modules registers them."""

from fluxloom.plans import column_queries, file_queries, flow_queries, series_queries, summary_queries  # noqa: F401
from fluxloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
