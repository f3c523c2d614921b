"""Named queries, each with an equivalent SQL text where SQL can express it."""

from reelgrove.plans import (  # noqa: F401  (importing registers the queries)
    additions,
    aggregates,
    chain,
    governance,
    monitoring,
    projections,
    questions,
    streams,
    tables,
    vectors,
)
from reelgrove.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
