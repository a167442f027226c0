"""D-section joins.

* D1 ``label_topics``: fact ⟕ curated dimension; the planner broadcasts it by
  its size.
* D2 ``entity_sentiment_counts``: the many-to-many title join of mentions to
  scored articles, computed WITHOUT emitting the pair rows: both sides are
  pre-aggregated on the join key, so the join multiplies counts instead of
  rows.  A hot title (e.g. the empty one) therefore costs one row per
  (title, entity) and (title, sentiment), and AQE can split the left side.
* D3 ``keep_top``: semi-join to a top-k key set (k rows, broadcast-safe).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def label_topics(df: DataFrame, labels: DataFrame, key: str = "topic") -> DataFrame:
    """Left join of articles to the topic-label dimension."""
    return df.join(labels, key, "left")


def null_safe_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Equi-join where null matches null (pandas ``merge`` semantics, X2)."""
    r = right.withColumnRenamed(key, "_rkey")
    out = left.join(r, left[key].eqNullSafe(r["_rkey"]), how)
    return out.drop("_rkey")


def entity_sentiment_counts(mentions: DataFrame, scored: DataFrame, key: str = "title_clean",
                            entity: str = "entity_text", label: str = "sentiment") -> DataFrame:
    """D2 + H1: ``count`` per (entity, sentiment) over the title join.

    Equal to joining every mention to every article with the same title and
    counting, then dropping null sentiments (pandas groupby drops null keys):
    count(e, s) = sum over titles of mentions(t, e) * articles(t, s).
    """
    m = mentions.dropna(subset=[entity]).groupBy(key, entity).agg(F.count(F.lit(1)).alias("_m"))
    a = scored.dropna(subset=[label]).groupBy(key, label).agg(F.count(F.lit(1)).alias("_a"))
    joined = null_safe_join(m, a, key, "inner")
    return joined.groupBy(entity, label).agg(F.sum(F.col("_m") * F.col("_a")).alias("count"))


def keep_top(df: DataFrame, key: str, k: int, weight: str | None = None) -> DataFrame:
    """D3: keep rows whose ``key`` is among the top ``k`` keys.

    Keys rank by row count (``weight=None``) or by the sum of ``weight``;
    ties by key.  The key set has exactly k rows, so broadcasting it is safe.
    """
    score = F.count(F.lit(1)) if weight is None else F.sum(weight)
    top = (
        df.dropna(subset=[key]).groupBy(key).agg(score.alias("_score"))
        .orderBy(F.col("_score").desc(), F.col(key)).limit(k).select(key)
    )
    return df.join(F.broadcast(top), key, "left_semi")


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two numeric arrays, in double."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)
