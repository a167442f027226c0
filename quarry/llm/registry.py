"""Named queries of the training-data operators and their DuckDB oracle SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Record ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco
