"""Registered queries, their inputs derived from the given tables, and their DuckDB twins."""

from replyforge.shipping import send_by_value
from suite.base import ORACLES, QUERIES
from suite import (  # noqa: F401  (importing a module registers its queries)
    calls,
    checkpoints,
    classify,
    columns,
    fetching,
    metrics,
    prompts,
    sources,
    tagging,
)

send_by_value("replyforge", "suite")

__all__ = ["ORACLES", "QUERIES"]
