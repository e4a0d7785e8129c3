"""Importing this module registers every query."""

from leadgrade.registry import (  # noqa: F401
    feature_queries,
    io_queries,
    model_queries,
    profile_queries,
    ranking_queries,
    text_queries,
)
from leadgrade.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
