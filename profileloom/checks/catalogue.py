"""All registered queries; importing this module fills the registry."""

from profileloom.checks import (  # noqa: F401
    evaluation_queries,
    extraction_queries,
    frontier_queries,
    page_queries,
    record_queries,
    rule_queries,
    run_queries,
)
from profileloom.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
