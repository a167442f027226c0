"""B-section filters and I4 deterministic dedup, as DataFrame transforms."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import null_to_empty


def filter_language(df: DataFrame, lang: str = L.LANGUAGE, col: str = "language") -> DataFrame:
    """B2: language equals ``lang``, case-blind (null language drops)."""
    return df.filter(F.lower(F.col(col).cast("string")) == lang.lower())


def filter_length(df: DataFrame, lo: int = L.MIN_TEXT_LEN, hi: int = L.MAX_TEXT_LEN, col: str = "text") -> DataFrame:
    """Raw text length within [lo, hi], null counts as length 0."""
    return df.filter(F.length(null_to_empty(col)).between(lo, hi))


def keep_curated(df: DataFrame, col: str = "keep") -> DataFrame:
    """Keep rows whose ``keep`` flag is 1 (null drops)."""
    return df.filter(F.col(col) == 1)


def filter_min_length(df: DataFrame, col: str, n: int, strict: bool = False) -> DataFrame:
    """B8 (``length >= n``) and B9 (``length > n``)."""
    ln = F.length(F.col(col))
    return df.filter(ln > n if strict else ln >= n)


def filter_not_match(df: DataFrame, col: str, pattern: str, case_blind: bool = True) -> DataFrame:
    """Drop rows whose column matches ``pattern`` (a null value drops too,
    like the pandas mask it mirrors would raise; nulls never reach here)."""
    pat = ("(?iu)" if case_blind else "") + pattern
    return df.filter(~F.col(col).rlike(pat))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """I4: keep the first row per key by ``order`` (e.g. file order or an id).

    One hash aggregate: ``min_by(struct(row), order)`` is partial-aggregatable,
    so every map task collapses its own duplicates before the shuffle and a
    key holding a third of all rows still moves one row per map task.  Null
    keys form one group (as in pandas ``drop_duplicates``).
    """
    keys = list(keys)
    order_c = F.col(order) if isinstance(order, str) else order
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), order_c).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others])
