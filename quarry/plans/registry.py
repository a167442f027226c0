"""Registry of named queries with their DuckDB oracle SQL side by side.

``@register(name, sql)`` records a ``(spark, sf_dir) -> DataFrame`` builder and,
when the result is SQL-expressible, the equivalent DuckDB SQL over the
pre-registered views (documents, labels, pages, embeddings, orders, ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        if headline:
            HEADLINE.append(name)
        return fn

    return deco


def sql_str(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_str(i) for i in items) + "]"


def widen_integers(df: DataFrame) -> DataFrame:
    """Result typing shared with SQL engines: 8/16/32-bit integers become
    64-bit (``length``/``size``/``row_number`` are 32-bit in Spark, BIGINT in
    most SQL engines)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ByteType, IntegerType, ShortType

    small = (ByteType, IntegerType, ShortType)
    if not any(isinstance(f.dataType, small) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("long").alias(f.name) if isinstance(f.dataType, small)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])
