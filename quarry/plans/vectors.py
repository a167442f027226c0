"""Stage 3 queries: similarity to a query vector and the top-share filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import embed_input, normalize_text, with_clean
from ..operators import relevance as R
from ..operators.text_vectors import fit_text_vectors, text_vectors
from ..sources.readers import table
from ..sources.writers import materialize
from .cleaning import english_articles
from .registry import register

QUERY_VEC_ID = 0
Q = 1 - L.KEEP_TOP_SHARE  # 0.30000000000000004, as the published report shows

SCORES_SQL = f"""
SELECT vec_id, list_dot_product(embedding::DOUBLE[],
       (SELECT embedding FROM embeddings WHERE vec_id = {QUERY_VEC_ID})::DOUBLE[]) AS semantic_score
FROM embeddings
"""
THRESHOLD_SQL = f"SELECT quantile_cont(semantic_score, {Q!r}) AS th FROM s"


def scored_embeddings(spark, sf_dir):
    """Every vector scored against vector ``QUERY_VEC_ID`` (scalar subquery:
    the query vector is one row, so no join is planned)."""
    emb = table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    query = emb.filter(F.col("vec_id") == QUERY_VEC_ID).select("embedding").scalar()
    return R.similarity(emb, "embedding", query).select("vec_id", "semantic_score")


@register("cosine_top_share", f"""
WITH s AS ({SCORES_SQL}), t AS ({THRESHOLD_SQL})
SELECT vec_id, round(semantic_score, 6) AS semantic_score FROM s, t WHERE semantic_score >= th
""", headline=True)
def q_cosine_top_share(spark, sf_dir):
    """E2 + E3 + B12: keep the top 70 % by score (ties kept)."""
    kept, _ = R.keep_top_share(scored_embeddings(spark, sf_dir), "semantic_score")
    return kept.select("vec_id", F.round("semantic_score", 6).alias("semantic_score"))


@register("filter_report", f"""
WITH s AS ({SCORES_SQL}), t AS ({THRESHOLD_SQL})
SELECT count(*) AS rows_before, count(*) FILTER (WHERE semantic_score >= th) AS rows_after,
       count(*) FILTER (WHERE semantic_score >= th) / count(*) AS keep_rate,
       {Q!r}::DOUBLE AS threshold_quantile, round(any_value(th), 6) AS threshold_value
FROM s, t
""")
def q_filter_report(spark, sf_dir):
    """The relevance-filter report as one row."""
    scored = materialize(scored_embeddings(spark, sf_dir), "scores")
    th = R.quantile(scored, "semantic_score", Q)
    rep = R.filter_report(scored, "semantic_score", th)
    return rep.withColumn("threshold_value", F.round("threshold_value", 6))


@register("score_stats", f"""
WITH s AS ({SCORES_SQL})
SELECT round(min(semantic_score), 6) AS min, round(avg(semantic_score), 6) AS mean,
       round(max(semantic_score), 6) AS max FROM s
""")
def q_score_stats(spark, sf_dir):
    """E5: min / mean / max of the scores."""
    st = R.score_stats(scored_embeddings(spark, sf_dir))
    return st.select(*[F.round(c, 6).alias(c) for c in ("min", "mean", "max")])


@register("text_relevance", None)
def q_text_relevance(spark, sf_dir):
    """E1 -> E2 -> E3 on the corpus: vectors fitted on title + first 1000
    characters, scored against the relevance query's vector, top 70 % kept.
    Rows-only check (the fit has no SQL counterpart)."""
    arts = with_clean(english_articles(spark, sf_dir), "text", "text_clean").select("article_id", "title", "text_clean")
    arts = materialize(arts.select("article_id", "title", embed_input(normalize_text("title"), "text_clean").alias("_in")), "embed_input")
    model = fit_text_vectors(arts, "_in")
    query = text_vectors(spark.range(1).select(F.lit(L.RELEVANCE_QUERY).alias("_in")), "_in", model).select("embedding").scalar()
    scored = R.similarity(text_vectors(arts, "_in", model), "embedding", query).select("article_id", "title", "semantic_score")
    kept, _ = R.keep_top_share(scored, "semantic_score")
    return kept
