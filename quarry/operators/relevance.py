"""E-section: embeddings, similarity, exact top-share filtering, reports.

``quantile`` is exact (linear interpolation, as ``numpy.quantile``): a few
counting passes narrow the value range down to the order statistics.
"""

from __future__ import annotations

import math
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions import lexicon as L
from ..functions.text import tokens
from .joins import dot
from ..sources.writers import materialize as _materialize


def similarity(df: DataFrame, vec_col: str, query: Column, name: str = "semantic_score") -> DataFrame:
    """Dot product with the query vector (cosine for unit vectors).

    ``query`` may be a scalar subquery: it is evaluated once and attached as a
    column before the (higher-order) dot product reads it.
    """
    return df.withColumn("_query", query).withColumn(name, dot(F.col(vec_col), F.col("_query"))).drop("_query")


# Bins of one counting pass; a pass sends the driver at most one row a bin.
BINS = 4096


def _magnitude(c: Column) -> Column:
    """Whole number that never falls as the value grows: sign and binary
    exponent; infinities, zero and NaN (the largest) have numbers of their own."""
    e = F.floor(F.log2(F.abs(c))) + 2000
    inf = F.lit(float("inf"))
    return (F.when(F.isnan(c), 9000).when(c == inf, 8000).when(c == -inf, -8000).when(c == 0, 0)
            .when(c > 0, e).otherwise(-e)).cast("long")


def order_statistics(df: DataFrame, col: str, rank: int, n_bins: int = BINS) -> tuple[float, float]:
    """The values at 0-based ``rank`` and ``rank + 1`` of a double column
    without nulls (the second equals the first at the end of the table).

    Counting passes instead of a sort: values are counted by sign and
    exponent, then the bin of the rank is cut into ``n_bins`` equal pieces until it
    holds one distinct value.  The values of one exponent have 52 bits, so five or six
    passes do whatever the distribution; ties, skew and infinities cost nothing.
    """
    c = F.col(col)
    lo = hi = after = None
    below = 0
    while True:
        if lo is None:
            part, key = df, _magnitude(c)
        else:
            part = df.filter((c >= F.lit(lo)) & (c <= F.lit(hi)))
            key = F.least(F.floor((c - F.lit(lo)) / F.lit(hi - lo) * n_bins), F.lit(n_bins - 1))
        bins = part.groupBy(key.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")
                                                  ).toPandas().sort_values("bin", ignore_index=True)
        upto = below + bins["n"].cumsum()
        k = int((upto > rank).to_numpy().argmax())
        if k + 1 < len(bins):
            after = float(bins["lo"][k + 1])
        below, lo, hi = int(upto[k] - bins["n"][k]), float(bins["lo"][k]), float(bins["hi"][k])
        if lo == hi or math.isnan(lo):
            return lo, lo if upto[k] > rank + 1 or after is None else after


def quantile(df: DataFrame, col: str, q: float, n_bins: int = BINS) -> float | None:
    """Exact ``q``-quantile of a numeric column (nulls ignored), linear
    interpolation between order statistics as ``numpy.quantile``."""
    nonnull = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias(col))
    n = nonnull.count()
    if n == 0:
        return None
    pos = (n - 1) * q
    k = int(math.floor(pos))
    frac = pos - k
    a, b = order_statistics(nonnull, col, k, n_bins)
    if frac == 0.0 or a == b:
        return a
    return a + (b - a) * frac if frac < 0.5 else b - (b - a) * (1 - frac)


def keep_top_share(df: DataFrame, score_col: str = "semantic_score", share: float = L.KEEP_TOP_SHARE,
                   materialize: bool = True) -> tuple[DataFrame, float]:
    """E3 + B12: keep rows with score >= the (1 - share) quantile (ties kept).

    With ``materialize`` the scored frame is written to the cluster's
    checkpoint folder first, so the scorer runs once even though the
    threshold and the filter both read the scores (X28).
    """
    scored = _materialize(df, "scores") if materialize else df
    threshold = quantile(scored, score_col, 1 - share)
    return scored.filter(F.col(score_col) >= F.lit(threshold)), threshold


def filter_report(before: DataFrame, score_col: str, threshold: float, share: float = L.KEEP_TOP_SHARE,
                  **settings) -> DataFrame:
    """Rows before / after, keep rate, quantile, threshold, settings - one aggregate."""
    r = before.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col(score_col) >= F.lit(threshold)).alias("rows_after"),
    )
    r = r.withColumn("keep_rate", F.col("rows_after") / F.col("rows_before"))
    r = r.withColumn("threshold_quantile", F.lit(1 - share)).withColumn("threshold_value", F.lit(threshold))
    for k, v in settings.items():
        r = r.withColumn(k, F.lit(v))
    return r


def score_stats(df: DataFrame, score_col: str = "semantic_score") -> DataFrame:
    """E5: min / mean / max of the scores."""
    c = F.col(score_col)
    return df.agg(F.min(c).alias("min"), F.avg(c).alias("mean"), F.max(c).alias("max"))


def hashed_embedding(df: DataFrame, text: Column, dim: int = 1024, out: str = "embedding") -> DataFrame:
    """E1 default encoder: L2-normalised hashed term counts (Spark ML
    ``HashingTF`` + ``Normalizer``), as ``array<float>``.  Deterministic and
    model-free; the neural encoder plugs in through ``embed_with``."""
    tmp = df.withColumn("_tok", tokens(text))
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim).transform(tmp)
    unit = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(tf)
    return unit.withColumn(out, vector_to_array("_unit", "float32")).drop("_tok", "_tf", "_unit")


def embed_with(df: DataFrame, text_col: str, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
               out: str = "embedding", batch_size: int = 256) -> DataFrame:
    """E1 hook: ``make_encoder()`` runs once per task and returns
    ``encode(texts) -> (n, d) array``; rows are L2-normalised here."""
    from pyspark.sql.types import StructField, StructType

    schema = StructType(df.schema.fields + [StructField(out, ArrayType(FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str).tolist()
            parts = [np.asarray(encode(texts[i:i + batch_size]), dtype=np.float32)
                     for i in range(0, len(texts), batch_size)]
            mat = np.vstack(parts) if parts else np.zeros((0, 1), np.float32)
            norms = np.linalg.norm(mat, axis=1, keepdims=True)
            mat = mat / np.where(norms == 0, 1, norms)
            pdf = pdf.copy()
            pdf[out] = list(mat)
            yield pdf

    return df.mapInPandas(run, schema)
