"""Named queries over the test tables, each with the SQL it is checked against."""

from fareflow.plans import lake, streams, trade, trips  # noqa: F401  (importing registers the queries)
from fareflow.plans.registry import QUERIES

__all__ = ["QUERIES"]
