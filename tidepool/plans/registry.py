"""Registry of named queries over the input tables, each with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``. Keys follow the operator ids of the
survey (``a7_skills_top``, ``w2_best_row_fused``...). Queries without an oracle are
the ones with no exact SQL equivalent (approximate sketches, behaviour checks).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL (or none)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its registrations run."""
    from tidepool.plans import (q_lineitem, q_documents, q_orders, q_pages,  # noqa: F401
                                q_events, q_metrics, q_conversations, q_roadmap)
