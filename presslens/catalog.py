"""Registry of the queries bound to the driver tables, with their DuckDB oracles.

Each plan module registers ``name -> fn(spark, sf_dir) -> DataFrame`` and, where
the result is expressible in SQL, the equivalent DuckDB query over the views
``documents events pages labels conversations benchmark embeddings ...``.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its registrations run."""
    from presslens.plans import (  # noqa: F401
        feed_clean, text_ops, url_rules, selection, bands_profile, agreement,
        evaluation, legacy, feed_view, store_ops, export, scoring, pages_ops,
        ingest, streaming_jobs, formats, json_docs, live_state, frontier_ops,
    )


def queries() -> dict[str, Callable]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
