"""Metric catalogue. Importing this package registers every metric."""

from metricforge.plans.common import ORACLE, QUERIES
from metricforge.plans import product, economy, realestate, venues, startups, games, talks  # noqa: F401

__all__ = ["QUERIES", "ORACLE"]
