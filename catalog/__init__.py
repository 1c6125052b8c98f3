"""Queries over the test tables, one per operator, each with the SQL that must agree with it."""

from catalog import (  # noqa: F401  (each module registers its queries)
    data_queries,
    feature_queries,
    function_queries,
    model_queries,
    quality_queries,
)
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
