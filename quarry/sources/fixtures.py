"""Adapters from the driver's test tables to the corpus shapes.

The analysed workflow reads news articles (url, date, language, title, text),
a topic-label dimension and per-article sentiment.  These adapters derive the
same shapes from ``documents``, ``pages``, ``labels`` and ``embeddings`` with
plain column expressions, so every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import table

# Adapter settings (fixture conventions, not corpus rules).
DATE_ORIGIN = "2022-01-01"
DATE_SPAN_DAYS = 1502  # 2022-01-01 .. 2026-02-10, the corpus date range


def first_line(c) -> F.Column:
    return F.substring_index(F.col(c) if isinstance(c, str) else c, "\n", 1)


def articles_from_documents(docs: DataFrame) -> DataFrame:
    """documents -> articles: title = first line, synthetic url/date."""
    return docs.select(
        F.col("doc_id").alias("article_id"),
        F.concat(F.lit("doc/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.date_add(F.lit(DATE_ORIGIN).cast("date"), F.pmod(F.col("doc_id"), F.lit(DATE_SPAN_DAYS)).cast("int"))
        .cast("timestamp").alias("date"),
        F.col("lang").alias("language"),
        F.trim(first_line("text")).alias("title"),
        F.col("text"),
        F.col("source"),
    )


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "documents", list(cols) or None, spread=True)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(documents(spark, sf_dir))


def sentiment_from_labels(labels: DataFrame) -> DataFrame:
    """labels -> (doc_id, sentiment): toxic -> negative, quality -> positive."""
    return labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
        .alias("sentiment"),
    )


def url_key(c) -> F.Column:
    """URL without scheme, ``www.``/``m.`` host prefix, query and fragment."""
    u = F.col(c) if isinstance(c, str) else c
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, r"^(www\.|m\.)", "")
    return F.regexp_replace(u, r"[?#].*$", "")
