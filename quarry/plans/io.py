"""Source / sink round trips (A2, A4-A7, K8) and the streaming report.

Every query writes under the shared checkpoint folder of the session, reads
the result back with the matching reader and returns it, so the oracle sees
what a downstream consumer of the files would see.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..operators import relevance as R
from ..operators import aggregates as A
from ..operators import filters as FL
from ..operators.aggregates import sample_n
from ..operators.filters import keep_curated
from ..operators.joins import label_topics
from ..sources import fixtures as FX
from ..sources import writers as W
from ..sources.readers import read_articles, read_labels
from ..streaming.incremental import run_tag_counts_stream
from . import reports, tagging, topics, vectors
from .registry import ORACLE, register


@register("labels_csv_roundtrip", ORACLE["topic_join_keep"])
def q_labels_csv_roundtrip(spark, sf_dir):
    """A5 -> A2 -> D1 -> B6: the curated label table written as CSV, read back
    with its explicit schema, joined to the items and filtered to kept topics."""
    path = W.write_report_csv(topics.topic_label_table(spark), W.scratch_path(spark, "topic_labels"))
    labels = read_labels(spark, path)
    docs = topics.embedding_topics(spark, sf_dir).select("vec_id", "topic")
    return keep_curated(label_topics(docs, labels, "topic")).select("vec_id", "topic", "topic_name", "industry_label")


@register("stage_roundtrip", ORACLE["clean_chain"])
def q_stage_roundtrip(spark, sf_dir):
    """A4: the cleaned stage written as parquet partitioned by industry, then
    re-read; a reader filtering on one industry would prune partitions."""
    clean = tagging.clean_articles(spark, sf_dir)
    path = W.write_stage(clean, W.scratch_path(spark, "clean_stage"), partition_by=["industry_label"])
    back = spark.read.parquet(path)
    return back.select("article_id", F.md5("text_clean").alias("text_md5"))


@register("report_json_roundtrip", ORACLE["filter_report"])
def q_report_json_roundtrip(spark, sf_dir):
    """The relevance-filter report written as JSON and read back."""
    scored = W.materialize(vectors.scored_embeddings(spark, sf_dir), "scores")
    th = R.quantile(scored, "semantic_score", vectors.Q)
    rep = R.filter_report(scored, "semantic_score", th).withColumn("threshold_value", F.round("threshold_value", 6))
    path = W.write_report_json(rep, W.scratch_path(spark, "filter_report"))
    return spark.read.json(path).select("rows_before", "rows_after", "keep_rate", "threshold_quantile",
                                        "threshold_value")


@register("sample_jsonl", None)
def q_sample_jsonl(spark, sf_dir):
    """A7 + J3: 100 sampled articles as JSON Lines with epoch-millisecond
    dates, read back (rows-only check)."""
    arts = FX.articles(spark, sf_dir).select("url", "date", "title", "text")
    sample = sample_n(arts, 100, "url", seed=42)
    path = W.write_jsonl(sample, W.scratch_path(spark, "sample_100"))
    return spark.read.json(path)


def _export(spark, sf_dir):
    """The articles are cleaned and written once for the three tables of their texts."""
    docs = topics.written_docs(spark, sf_dir)
    arts = docs.select("article_id", F.col("topic").alias("industry_label"), "text_clean")
    return W.export_dashboard(
        reports.q_dashboard_series(spark, sf_dir),
        topics.summary_of(spark, docs),
        tagging.impact_counts(arts),
        tagging.technology_counts(arts),
        W.scratch_path(spark, "dashboard"),
    )


# What the rows of each dashboard file are told apart by, and their number.
DASHBOARD_ROWS = [
    ("sentiment_over_time", "date", "sentiment", "count"), ("topics", "final_topic", "industry", "topic_size"),
    ("industry_impact_counts", "industry_label", "impact_modes", "count"),
    ("industry_technology_counts", "industry_label", "technologies", "count")]


@register("dashboard_files", " UNION ALL ".join(
    f"SELECT '{name}' AS file, CAST({a} AS VARCHAR) AS key, CAST({b} AS VARCHAR) AS label, CAST({n} AS BIGINT) AS count FROM ({sql})"
    for (name, a, b, n), sql in zip(DASHBOARD_ROWS, (
        ORACLE["dashboard_series"], ORACLE["dashboard_topics"], ORACLE["impact_counts"], ORACLE["technology_counts"]))))
def q_dashboard_files(spark, sf_dir):
    """K8: the four dashboard JSON tables written, then every row of every file
    read back in one long form."""
    files = _export(spark, sf_dir)
    parts = [spark.read.json(files[name]).select(F.lit(name).alias("file"), F.col(a).cast("string").alias("key"),
                                                 F.col(b).cast("string").alias("label"), F.col(n).cast("long").alias("count"))
             for name, a, b, n in DASHBOARD_ROWS]
    return reduce(DataFrame.unionByName, parts)


@register("dashboard_export", ORACLE["dashboard_series"])
def q_dashboard_export(spark, sf_dir):
    """K8: write the four dashboard JSON tables; return the re-read series."""
    files = _export(spark, sf_dir)
    return spark.read.json(files["sentiment_over_time"]).select("date", "sentiment", "count", "total", "pct")


@register("tag_counts_stream", ORACLE["tag_counts"])
def q_tag_counts_stream(spark, sf_dir):
    """Structured Streaming form of the flagship report: the documents file is
    consumed as a stream (available-now trigger) and folded into running
    (industry, tag) counts kept in the streaming state."""
    out = W.scratch_path(spark, "tag_counts_stream")
    return run_tag_counts_stream(spark, sf_dir, "documents.parquet", tagging.FIXTURE_TAGS,
                                 os.path.join(out, "result"), os.path.join(out, "checkpoint"))


@register("raw_corpus_roundtrip", f"""
WITH r AS (SELECT doc_id, lang, text, CAST(DATE '2022-01-01' + CAST(doc_id % 1502 AS INTEGER) AS TIMESTAMP) AS date
           FROM documents)
SELECT CAST(count(date) AS DOUBLE) * 100.0 / count(*) AS parse_success_pct,
       strftime(min(date), '%Y-%m-%d %H:%M:%S+00:00') AS min_date_utc,
       strftime(max(date), '%Y-%m-%d %H:%M:%S+00:00') AS max_date_utc,
       count(*) FILTER (WHERE date IS NULL) AS n_missing_date,
       count(*) FILTER (WHERE lower(lang) = 'en' AND length(coalesce(text, '')) BETWEEN {L.MIN_TEXT_LEN} AND
                        {L.MAX_TEXT_LEN}) AS rows_kept
FROM r
""")
def q_raw_corpus_roundtrip(spark, sf_dir):
    """A1 + B1 + B2 + B3 + I4 + H3: a raw corpus file (dates as strings) is
    read with the canonical reader, dates parsed, the time report taken over
    all rows, then language / length filters and first-row-per-url dedup in
    file order."""
    raw = FX.articles(spark, sf_dir).select(
        "url", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "language", "title", "text")
    path = W.write_stage(raw, W.scratch_path(spark, "raw_corpus"))
    arts = read_articles(spark, path)
    report = A.time_report(arts, "date")
    kept = FL.dedup_first(FL.filter_length(FL.filter_language(arts)), ["url"], "_file_order")
    return report.withColumn("rows_kept", kept.select(F.count(F.lit(1))).scalar())
