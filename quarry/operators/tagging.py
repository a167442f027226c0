"""Tag articles with dictionaries and produce the long (exploded) forms."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.tagging import tag
from .aggregates import count_by

Dictionary = Mapping[str, Sequence[str]]


def tag_articles(df: DataFrame, text_col: str = "text_clean",
                 dictionaries: Mapping[str, Dictionary] | None = None,
                 mode: str = "substring", engine: str = "contains") -> DataFrame:
    """Add one sorted label array per dictionary (default: impact, technology)."""
    dictionaries = dictionaries or {"impact_modes": L.IMPACT_KEYWORDS, "technologies": L.TECHNOLOGY_KEYWORDS}
    return df.withColumns({name: tag(text_col, d, mode=mode, engine=engine) for name, d in dictionaries.items()})


def explode_tags(df: DataFrame, tags_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per tag; rows with an empty tag list disappear.

    Written as ``explode_outer`` + a null filter on the output: a plain
    ``explode`` makes Catalyst infer ``size(tags) > 0`` and push it below the
    projection, which inlines the whole cleaning chain once per phrase.
    """
    out = df.select(*keep, F.explode_outer(tags_col).alias(tags_col))
    return out.filter(F.col(tags_col).isNotNull())


def tag_counts(df: DataFrame, group: str, tags_col: str) -> DataFrame:
    """K2/K3: (group, tag) counts of an exploded tag column."""
    return count_by(explode_tags(df, tags_col, keep=[group]), group, tags_col)
