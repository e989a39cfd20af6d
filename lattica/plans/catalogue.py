"""All registered queries and their SQL."""

from lattica.plans import queries, queries2
from lattica.plans.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "queries", "queries2"]
