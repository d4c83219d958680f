"""Named queries over the test tables, with oracle SQL."""

from martflow.queries import (  # noqa: F401
    aggregates,
    columns,
    functions,
    joins,
    keyed,
    plans,
    quality,
    sinks,
    sources,
    streaming,
    tables,
)
from martflow.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
