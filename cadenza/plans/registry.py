"""Query registry: each entry pairs a Spark plan ``fn(spark, sf_dir)`` with
its DuckDB oracle SQL (or ``None`` for invariant-checked operators)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cadenza.plans.oracle import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    headline: bool = False


ENTRIES: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, extra_views: dict[str, str] | None = None, headline: bool = False):
    """Decorator: register ``fn`` under ``name`` with optional oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        full = with_views(sql, extra_views) if sql else None
        ENTRIES[name] = Entry(name, fn, full, headline)
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    # importing the query modules fills ENTRIES
    from cadenza.plans import q_catalog, q_discover, q_enrich, q_ml, q_recommend, q_stream  # noqa: F401

    return ENTRIES
