"""The eight stages end to end on a raw corpus file derived from the documents."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry import stages as S
from quarry.operators.sentiment import labelled_examples
from quarry.sources import fixtures as FX
from quarry.sources import writers as W


def test_stages_end_to_end(spark):
    out = W.scratch_path(spark, "stages")
    raw = FX.articles(spark, SF_SMALL).select(
        "url", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "language", "title", "text")
    raw_path = W.write_stage(raw, os.path.join(out, "raw"))
    training = labelled_examples(spark, SF_SMALL).withColumnRenamed("doc_id", "id")
    train_path = W.write_stage(training, os.path.join(out, "training"))

    s1 = S.stage_clean(spark, raw_path, out)
    s2 = S.stage_light_clean(spark, s1["clean"], out)
    s3 = S.stage_relevance(spark, s2["light_clean"], out)
    s4 = S.stage_topics(spark, s3["relevant"], out, min_samples=3, min_cluster_size=5)
    s5 = S.stage_entities(spark, s4["labelled"], out)
    s6 = S.stage_tagging(spark, s4["labelled"], out)
    s7 = S.stage_train(spark, train_path, os.path.join(out, "model"))
    s8 = S.stage_sentiment(spark, s4["labelled"], s5["entities"], out, model_dir=s7["model"])

    n_clean = spark.read.parquet(s2["light_clean"]).count()
    assert n_clean == raw.filter("lower(language) = 'en' AND length(text) BETWEEN 500 AND 50000").count()
    n_rel = spark.read.parquet(s3["relevant"]).count()
    assert n_clean - n_rel <= int(0.3 * (n_clean - 1)) + 1  # rows below numpy's interpolated quantile
    rep = spark.read.json(s3["filter_report"]).first()
    assert rep.rows_before == n_clean and rep.rows_after == n_rel
    n_lab = spark.read.parquet(s4["labelled"]).count()
    assert 0 < n_lab <= n_rel
    assert spark.read.option("header", True).csv(s4["topic_info"]).count() >= 1
    scored = spark.read.parquet(s8["article_sentiment"])
    assert scored.count() == n_lab
    assert set(r.sentiment for r in scored.select("sentiment").distinct().collect()) <= {"negative", "neutral", "positive"}
    topic = spark.read.option("header", True).option("inferSchema", True).csv(s8["topic_sentiment"])
    assert (topic.agg(F.sum("count")).first()[0] or 0) == n_lab
    assert spark.read.parquet(s6["tagged"]).count() == n_lab


def _cleanings(monkeypatch, run):
    from quarry.functions import text as T

    calls, clean = [], T.with_clean
    monkeypatch.setattr(T, "with_clean", lambda *a: calls.append(1) or clean(*a))
    run()
    return len(calls)


def test_dashboard_export_cleans_the_articles_once(spark, monkeypatch):
    from quarry.plans.io import q_dashboard_files

    assert _cleanings(monkeypatch, lambda: q_dashboard_files(spark, "/root/testdata/sf0.001")) == 1


def test_representative_texts_cleans_the_articles_once(spark, monkeypatch):
    from quarry.plans.topics import q_representative_texts

    assert _cleanings(monkeypatch, lambda: q_representative_texts(spark, "/root/testdata/sf0.001")) == 1


def test_representatives_of_repeated_ids_and_terms_outside_the_vocabulary(spark):
    from quarry.operators import topics as TP

    occ = spark.createDataFrame([(d, "t", w) for d, text in ((1, "a b x"), (1, "a b x"), (2, "a a y y"), (3, "z")) for w in text.split()],
                                "doc_id long, topic string, term string")
    w = spark.createDataFrame([("t", "a", 1, 1.0, 1.0), ("t", "b", 1, 2.0, 2.0)], "topic string, term string, tf long, idf double, weight double")
    got = [(r["rank"], r["doc_id"], round(r["similarity"], 6)) for r in TP.representative_texts(occ, w, 3).orderBy("rank").collect()]
    assert got == [(1, 1, 1.0), (2, 2, round(1 / 5 ** 0.5, 6))]
