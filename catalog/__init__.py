"""Registered queries over the given tables, with their comparison SQL."""

from catalog import source_queries, text_queries, count_queries, search_queries, vote_queries, evaluation_queries, model_queries, chain_queries  # noqa: F401, I001
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
