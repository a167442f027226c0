"""The corpus workflow as eight stage functions over real article files.

Each stage reads the previous stage's parquet table, runs the operators of
this package and writes its own table plus the reports of that step, exactly
the hand-over points of the analysed workflow (raw -> clean -> light-clean ->
relevant -> topic-labelled -> entities / tags -> classifier -> sentiment
reports).  Paths are the caller's; every stage returns the paths it wrote.

Models are pluggable: ``make_encoder`` (texts -> vectors), ``make_extractor``
(texts -> entity dicts) and the Spark ML classifier, or ``make_scorer`` for an
external sentiment model.  Without them the rule-based defaults run.
"""

from __future__ import annotations

import os
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates as D
from .functions import lexicon as L
from .functions import text as T
from .operators import aggregates as A
from .operators import filters as FL
from .operators import relevance as R
from .operators import sentiment as SN
from .operators import topics as TP
from .operators.density import density_clusters
from .operators.entities import company_counts, extract_entities, extract_with
from .operators.joins import entity_sentiment_counts, label_topics
from .operators.tagger import Tagger, tag_entities
from .operators.tagging import tag_articles, tag_counts
from .operators.text_vectors import fit_text_vectors, text_vectors
from .sources import writers as W
from .sources.readers import read_articles, read_labels, read_training

def _p(out_dir: str, name: str) -> str:
    return os.path.join(out_dir, name)


def stage_clean(spark: SparkSession, raw_path: str, out_dir: str, colmap: Mapping[str, str] | None = None) -> dict:
    """1: read, parse dates, time report, 100-row sample, language / length
    filters, first row per url (file order), normalise title and text."""
    arts = read_articles(spark, raw_path, colmap)
    out = {
        "time_report": W.write_report_json(A.time_report(arts, "date"), _p(out_dir, "time_report")),
        "sample": W.write_jsonl(A.sample_n(arts.select("url", "date", "title", "text"), 100, "url"),
                                _p(out_dir, "sample_100")),
    }
    kept = FL.dedup_first(FL.filter_length(FL.filter_language(arts)), ["url"], "_file_order")
    clean = kept.select("url", "date", T.normalize_text("title").alias("title_clean"),
                        T.normalize_text("text").alias("text_clean"))
    out["clean"] = W.write_stage(clean, _p(out_dir, "clean"))
    return out


def stage_light_clean(spark: SparkSession, in_path: str, out_dir: str) -> dict:
    """2: e-mails, phone numbers, boilerplate phrases out of the text."""
    df = spark.read.parquet(in_path)
    return {"light_clean": W.write_stage(T.with_steps(df, "text_clean", "text_clean", T.LIGHT_CLEAN_STEPS),
                                         _p(out_dir, "light_clean"))}


def _encoder(df: DataFrame, text: str, make_encoder) -> Callable[[DataFrame], DataFrame]:
    """Frame -> frame with ``embedding``: the caller's encoder, else vectors
    fitted on the texts of ``df``."""
    if make_encoder is not None:
        return lambda frame: R.embed_with(frame, text, make_encoder)
    model = fit_text_vectors(df, text)
    return lambda frame: text_vectors(frame, text, model)


def stage_relevance(spark: SparkSession, in_path: str, out_dir: str, make_encoder=None,
                    query: str = L.RELEVANCE_QUERY, share: float = L.KEEP_TOP_SHARE) -> dict:
    """3: embed title + first 1000 characters, score against the query,
    keep the top share (exact quantile, ties kept), report."""
    df = spark.read.parquet(in_path).withColumn("_in", T.embed_input("title_clean", "text_clean"))
    encode = _encoder(df, "_in", make_encoder)
    qv = encode(spark.createDataFrame([(query,)], "_in string")).select("embedding").scalar()
    scored = W.materialize(R.similarity(encode(df), "embedding", qv).drop("_in", "embedding"), "scores")
    kept, threshold = R.keep_top_share(scored, "semantic_score", share, materialize=False)
    report = R.filter_report(scored, "semantic_score", threshold, share,
                             max_chars_used=L.EMBED_MAX_CHARS)
    return {
        "relevant": W.write_stage(kept, _p(out_dir, "relevant")),
        "filter_report": W.write_report_json(report, _p(out_dir, "filter_report")),
    }


def stage_topics(spark: SparkSession, in_path: str, out_dir: str, labels_csv: str | None = None,
                 make_encoder=None, min_samples: int = L.MIN_SAMPLES, min_cluster_size: int = L.MIN_CLUSTER_SIZE) -> dict:
    """4: topic text -> embeddings -> 5 components -> density topics ->
    c-TF-IDF keywords (topic info) -> curated labels -> kept articles."""
    df = spark.read.parquet(in_path).withColumn("topic_text", T.topic_text("title_clean", "text_clean"))
    emb = _encoder(df, "topic_text", make_encoder)(df.select("url", "topic_text"))
    red = W.materialize(TP.reduce_dims(emb, "embedding", L.REDUCED_DIMS, "reduced"), "reduced")
    topics = density_clusters(red, "reduced", min_samples, min_cluster_size, id_col="url").select("url", "topic")
    docs = W.materialize(df.join(topics, "url"), "topic_docs")
    occ = TP.doc_terms(docs, "topic_text", ["url", "topic"], TP.topic_stopwords())
    n_topics = docs.select(F.count_distinct("topic")).scalar()
    tf = W.materialize(TP.restrict_to_vocabulary(TP.topic_term_counts(occ), L.MIN_DF, L.MAX_DF, n_topics), "tf")
    weights = TP.class_tfidf(tf, "topic")
    info = TP.topic_info(docs, TP.topic_keywords(weights, L.TOP_N_WORDS))
    reps = TP.representative_texts(occ, weights, 3, id_col="url").groupBy("topic").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("rank", "url")))["url"], " | ").alias("representative_docs"))
    out = {"topic_info": W.write_report_csv(info.join(reps, "topic", "left").orderBy(F.col("count").desc(), "topic"),
                                            _p(out_dir, "topic_info"))}
    if labels_csv:
        labels = read_labels(spark, labels_csv)
    else:
        labels = spark.createDataFrame(L.TOPIC_LABELS, "topic int, topic_name string, industry_label string, keep int")
    kept = FL.keep_curated(label_topics(docs, labels, "topic"))
    out["labelled"] = W.write_stage(
        kept.select("url", "date", "title_clean", "text_clean", "topic", "topic_name", "industry_label"),
        _p(out_dir, "labelled"))
    return out


def stage_entities(spark: SparkSession, in_path: str, out_dir: str, make_extractor=None, tagger: Tagger | None = None) -> dict:
    """5: organisation mentions (by ``make_extractor``'s model, else by ``tagger``, else by
    rule), then company counts per industry."""
    df = spark.read.parquet(in_path)
    keep = ["url", "date", "topic", "topic_name", "industry_label", "title_clean"]
    if make_extractor is not None:
        ments = extract_with(df, make_extractor, keep=keep)
    elif tagger is not None:
        ments = tag_entities(df.withColumn("_in", T.entity_input("title_clean", "text_clean")), "_in", tagger, keep=keep)
    else:
        ments = extract_entities(df, keep=keep)
    path = W.write_stage(ments.filter(F.col("entity_label") == "ORG"), _p(out_dir, "entities"))
    counts = company_counts(spark.read.parquet(path))
    return {"entities": path, "company_counts": W.write_report_csv(counts, _p(out_dir, "company_counts"), single=False)}


def stage_tagging(spark: SparkSession, in_path: str, out_dir: str) -> dict:
    """6: impact and technology tags, per-industry counts."""
    tagged = W.write_stage(tag_articles(spark.read.parquet(in_path), "text_clean"), _p(out_dir, "tagged"))
    t = spark.read.parquet(tagged)
    order = [F.col("industry_label"), F.col("count").desc()]
    return {
        "tagged": tagged,
        "impact_counts": W.write_report_csv(tag_counts(t, "industry_label", "impact_modes").orderBy(*order, "impact_modes"),
                                            _p(out_dir, "industry_impact_counts")),
        "technology_counts": W.write_report_csv(
            tag_counts(t, "industry_label", "technologies").orderBy(*order, "technologies"),
            _p(out_dir, "industry_technology_counts")),
    }


def stage_train(spark: SparkSession, training_path: str, model_dir: str, id_col: str = "id",
                split_col: str | None = "split") -> dict:
    """7: fit the classifier on train, pick the best on validation, save."""
    data = read_training(spark, training_path, id_col, split_col)
    model, metrics = SN.train_classifier(data, text_col="text")
    SN.save_model(model, model_dir)
    return {"model": model_dir, "metrics": W.write_report_json(metrics, model_dir.rstrip("/") + "_metrics")}


def stage_sentiment(spark: SparkSession, articles_path: str, entities_path: str, out_dir: str,
                    model_dir: str | None = None, make_scorer: Callable | None = None) -> dict:
    """8: score every article once (written), then sentiment by topic, by
    entity (title join) and by month."""
    df = spark.read.parquet(articles_path)
    if make_scorer is not None:
        scored = SN.score_with(df, make_scorer)
    else:
        scored = SN.score_sentiment(df, SN.load_model(model_dir))
    sp = W.write_stage(scored, _p(out_dir, "article_sentiment"))
    s = spark.read.parquet(sp)
    topic = A.add_share(A.count_by(s, "topic_name", "sentiment"), "topic_name")
    ents = spark.read.parquet(entities_path)
    entity = entity_sentiment_counts(ents, s, "title_clean")
    month = A.add_share(A.count_by_month(s, "date", "sentiment"), "date")
    return {
        "article_sentiment": sp,
        "topic_sentiment": W.write_report_csv(topic.orderBy("topic_name", F.col("count").desc(), "sentiment"),
                                              _p(out_dir, "topic_sentiment")),
        "entity_sentiment": W.write_report_csv(entity.orderBy(F.col("count").desc(), "entity_text", "sentiment"),
                                               _p(out_dir, "entity_sentiment"), single=False),
        "sentiment_over_time": W.write_stage(month, _p(out_dir, "sentiment_over_time")),
        "dashboard_series": W.write_report_json(
            A.add_share(A.count_by(s.withColumn("date", D.month_label("date")), "date", "sentiment"), "date")
            .withColumn("pct", D.share10("pct")), _p(out_dir, "dashboard_sentiment_over_time")),
    }
