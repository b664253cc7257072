"""Registered queries over the given tables, each with its SQL where SQL can say it."""

from corpusprep.queries import (  # noqa: F401
    candidate_queries, context_queries, example_queries, metric_queries, problem_queries,
    source_queries, sequence_queries, stream_queries, token_queries, vector_queries)
from corpusprep.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
