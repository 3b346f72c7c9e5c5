"""Named queries over the driver's tables, each paired (where SQL can express
it) with an equivalent DuckDB oracle query.  Every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the catalog modules registers their queries
    from threadsift.plans import (catalog_base, catalog_identity, catalog_pages,  # noqa: F401
                                  catalog_profiles, catalog_quality, catalog_reports,
                                  catalog_sketches, catalog_streaming, catalog_tags)
