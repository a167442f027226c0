"""Every registered query against its DuckDB oracle on the smallest scale,
plus the driver entry points."""

import os

import pytest
import regex

from conftest import SF_MID, SF_SMALL

import __spark_entry__ as entry_mod
from quarry.plans import ORACLE, QUERIES
from quarry.plans.registry import widen_integers
from quarry.plans.verify import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, lambda s, d: widen_integers(QUERIES[name](s, d)), ORACLE[name], SF_SMALL, con)
    assert res["match"], res


EN_LEN = "lower(lang) = 'en' AND length(coalesce(text, '')) BETWEEN 500 AND 50000"


def rows(spark, name):
    return QUERIES[name](spark, SF_SMALL).collect()


def test_every_query_without_sql_has_a_test():
    assert set(QUERIES) - set(ORACLE) == {
        "sample_articles", "sample_jsonl", "classifier_selection", "sentiment_scores", "text_relevance", "reduced_dims",
        "density_topics", "document_topics", "unseen_topics", "outliers_reduced", "tagged_mentions",
        "epoch_training", "epoch_sentiment"}


def test_tagged_mentions_are_scored_spans_near_the_rule(spark):
    """The tagger learns the rule's spans: most of both agree, with offsets into the text."""
    from quarry.plans.entities import articles

    got = rows(spark, "tagged_mentions")
    texts = {r["article_id"]: f"{r['title_clean']}. {r['text_clean']}" for r in articles(spark, SF_SMALL).collect()}
    rule = {(i, m.start(), m.end()) for i, t in texts.items() for m in regex.finditer(r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*", t)}
    found = {(r["article_id"], r["start"], r["end"]) for r in got}
    assert len(found) == len(got) and all(0 < r["score"] < 1 for r in got)
    assert all(texts[r["article_id"]][r["start"]:r["end"]].strip(" .,;:|()[]{}\"'") == r["entity_text"] for r in got)
    assert len(found & rule) >= 0.95 * max(len(found), len(rule))


def test_samples_are_subsets_and_repeat(spark, con):
    got = rows(spark, "sample_articles")
    ids = {r["article_id"] for r in got}
    assert len(got) == len(ids) == 100 and ids == {r["article_id"] for r in rows(spark, "sample_articles")}
    urls = dict(con.execute("SELECT doc_id, 'doc/' || source || '/' || doc_id FROM documents").fetchall())
    assert all(r["url"] == urls[r["article_id"]] for r in got)
    assert {r["url"] for r in rows(spark, "sample_jsonl")} <= set(urls.values())


def test_selection_reports_every_candidate(spark):
    got = rows(spark, "classifier_selection")
    assert [r["reg"] for r in got] == [0.0, 0.01, 0.1]
    assert all(0 <= r["accuracy"] <= 1 and 0 <= r["f1_weighted"] <= 1 for r in got)


def test_epochs_are_reported_in_order_with_one_best(spark):
    got = rows(spark, "epoch_training")
    assert [r["epoch"] for r in got] == [1, 2, 3] and got[-1]["train_loss"] < got[0]["train_loss"]
    (best,) = [r for r in got if r["best"]]
    assert best["f1_weighted"] == max(r["f1_weighted"] for r in got)


@pytest.mark.parametrize("name", ["sentiment_scores", "epoch_sentiment"])
def test_every_kept_article_is_scored_once(spark, con, name):
    got = rows(spark, name)
    want = [i for (i,) in con.execute(f"SELECT doc_id FROM documents WHERE {EN_LEN}").fetchall()]
    assert sorted(r["article_id"] for r in got) == sorted(want)
    assert {r["sentiment"] for r in got} <= {"negative", "neutral", "positive"}
    assert all(0 < r["sentiment_score"] <= 1 for r in got)


def test_relevance_keeps_the_top_share(spark, con):
    got = rows(spark, "text_relevance")
    (n,) = con.execute(f"SELECT count(*) FROM documents WHERE {EN_LEN}").fetchone()
    assert n - len(got) <= int(0.3 * (n - 1)) + 1 and len({r["article_id"] for r in got}) == len(got)


def test_components_are_ordered_by_variance(spark, con):
    import numpy as np

    got = rows(spark, "reduced_dims")
    (n,) = con.execute("SELECT count(*) FROM embeddings").fetchone()
    assert len(got) == n
    x = np.array([r["reduced"] for r in got])
    assert x.shape == (n, 5) and (np.diff(x.var(axis=0)) <= 1e-9).all()
    assert x.var(axis=0).min() > 0


def test_every_vector_has_a_topic(spark, con):
    (n,) = con.execute("SELECT count(*) FROM embeddings").fetchone()
    for name in ("density_topics", "outliers_reduced"):
        got = rows(spark, name)
        assert len({r["vec_id"] for r in got}) == len(got) == n
        assert min(r["topic"] for r in got) >= -1


def test_unseen_documents_join_the_topic_of_their_language(spark):
    """Every odd document once; members of one topic are nearly all of one language."""
    lang = dict(duck(SF_MID).execute("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["unseen_topics"](spark, SF_MID).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i in lang if i % 2)
    by_topic = {}
    for r in got:
        by_topic.setdefault(r["topic"], []).append(lang[r["doc_id"]])
    members = {t: v for t, v in by_topic.items() if t >= 0}
    assert len(members) > 1 and sum(map(len, members.values())) > len(got) / 2
    assert all(max(map(v.count, v)) >= 0.9 * len(v) for v in members.values() if len(v) >= 5)


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["industry_label", "tag", "count"]
    assert df.count() > 0
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_every_query_reads_tables(spark, monkeypatch):
    """A query that names no table would fail to fail here."""
    for name, fn in QUERIES.items():
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
            fn(spark, "/nowhere").collect()
