"""The catalogue of queries: name, Spark plan, DuckDB SQL."""

from __future__ import annotations

from tidewire.plans import event_queries, evidence_queries, graph_queries, log_more, log_queries, mechanism_queries, more_queries, page_queries, read_queries, rule_queries, state_queries, story_queries, text_queries, unit_queries  # noqa: F401
from tidewire.plans.registry import ORACLES, QUERIES

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]


def FLAGSHIP(spark, sf_dir):
    return QUERIES["tier1_gate"](spark, sf_dir)
