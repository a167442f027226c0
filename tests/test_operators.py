"""DataFrame operators on small in-line frames: edge rows and properties."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions import lexicon as L
from quarry.functions.tagging import minimal_phrases, tag
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import relevance as R
from quarry.operators import topics as TP
from quarry.operators.density import density_clusters
from quarry.operators.entities import companies
from quarry.operators.joins import entity_sentiment_counts, keep_top
from quarry.operators.sentiment import evaluate
from quarry.operators.tagging import explode_tags


TAG_TEXTS = [
    "We automate the back office with RPA and a copilot.",
    "Counterparty risk may surpass expectations; fulfillment is biased.",
    "Nothing to see here.",
    None,
    "Large Language Models and GenAI reduce costs; LLMs everywhere.",
    "A human-in-the-loop assistant helps us speed up.",
]


# The labels of TAG_TEXTS, read off the dictionaries by hand ("rpa" hits
# "counterparty", "llm" hits "fulfillment").
IMPACT_TAGS = [["augmentation", "automation"], ["automation", "risk_or_disruption"], [], [], ["cost_reduction"],
               ["augmentation", "productivity_gain"]]
TECHNOLOGY_TAGS = [["automation_platform", "chatbot_or_assistant"], ["automation_platform", "llm"], [], [], ["llm"], []]


@pytest.mark.parametrize("engine", ["contains", "rlike"])
@pytest.mark.parametrize("dictionary, want", [(L.IMPACT_KEYWORDS, IMPACT_TAGS), (L.TECHNOLOGY_KEYWORDS, TECHNOLOGY_TAGS)])
def test_tag_substring_labels(spark, engine, dictionary, want):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TAG_TEXTS)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(tag("t", dictionary, engine=engine)).collect()] == want


def test_unknown_engines_and_modes_are_refused(spark):
    for options in ({"engine": "auto"}, {"mode": "stem"}):
        with pytest.raises(ValueError, match="unknown"):
            tag("t", {"a": ["b"]}, **options)


def test_tag_word_mode_needs_boundaries(spark):
    d = {"rpa": ["rpa"], "llm": ["llm"]}
    df = spark.createDataFrame([(0, "surpass fulfillment"), (1, "RPA and LLM."), (2, "rpa_x llmé")], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(tag("t", d, mode="word")).collect()]
    assert got == [[], ["llm", "rpa"], []]


def test_minimal_phrases_drop_supersets():
    assert minimal_phrases(["automated", "automate", "automation", "rpa"]) == ["rpa", "automate", "automation"]


def test_explode_drops_empty_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, tags array<string>")
    assert sorted(tuple(r) for r in explode_tags(df, "tags", ["k"]).collect()) == [(1, "a"), (1, "b")]


def test_dedup_first_keeps_first_by_order_and_null_key(spark):
    rows = [("u1", 3, "c"), ("u1", 1, "a"), ("u2", 2, "b"), (None, 5, "n2"), (None, 4, "n1")]
    df = spark.createDataFrame(rows, "url string, ord int, v string")
    got = sorted((r.url or "", r.v) for r in FL.dedup_first(df, ["url"], "ord").collect())
    assert got == [("", "n1"), ("u1", "a"), ("u2", "b")]


def test_count_by_drops_null_keys_and_share_sums_to_one(spark):
    rows = [("t1", "pos"), ("t1", "neg"), ("t1", "pos"), ("t2", None), ("t2", "neu"), (None, "pos")]
    df = spark.createDataFrame(rows, "topic string, s string")
    c = A.add_share(A.count_by(df, "topic", "s"), "topic")
    got = {(r.topic, r.s): (r["count"], r.total) for r in c.collect()}
    assert got == {("t1", "pos"): (2, 3), ("t1", "neg"): (1, 3), ("t2", "neu"): (1, 1)}
    sums = c.groupBy("topic").agg(F.sum("pct").alias("p")).collect()
    assert all(abs(r.p - 1) < 1e-12 for r in sums)


def test_top_k_per_group_breaks_ties_by_label(spark):
    rows = [("a", "x", 5), ("a", "y", 5), ("a", "z", 1), ("b", "x", 2)]
    df = spark.createDataFrame(rows, "g string, l string, count long")
    top = A.top_k_per_group(df, "g", 1, [F.col("count").desc(), F.col("l")])
    assert sorted((r.g, r.l) for r in top.collect()) == [("a", "x"), ("b", "x")]


def test_keep_top_by_weight(spark):
    rows = [("e1", 5), ("e2", 1), ("e2", 1), ("e3", 3), ("e1", 1)]
    df = spark.createDataFrame(rows, "k string, count long")
    assert sorted({r.k for r in keep_top(df, "k", 2, weight="count").collect()}) == ["e1", "e3"]


def test_entity_sentiment_equals_pair_join(spark):
    # duplicate titles multiply, null titles match each other, null sentiment drops
    mentions = [("T1", "Acme"), ("T1", "Acme"), ("T2", "Beta"), (None, "Gamma"), ("T3", "Acme")]
    scored = [("T1", "pos"), ("T1", "neg"), ("T1", "pos"), ("T2", None), (None, "neu"), ("T4", "pos")]
    m = spark.createDataFrame(mentions, "title_clean string, entity_text string")
    s = spark.createDataFrame(scored, "title_clean string, sentiment string")
    got = {(r.entity_text, r.sentiment): r["count"] for r in entity_sentiment_counts(m, s).collect()}
    pm, ps = pd.DataFrame(mentions, columns=["t", "e"]), pd.DataFrame(scored, columns=["t", "s"])
    want = pm.merge(ps, on="t", how="left").groupby(["e", "s"]).size().to_dict()
    assert got == want


@pytest.mark.parametrize("n,seed", [(1, 0), (2, 1), (7, 2), (500, 3), (1001, 4)])
def test_quantile_is_exact(spark, n, seed):
    rnd = random.Random(seed)
    vals = [rnd.choice([0.1, 0.2, 0.2, 0.5]) if seed % 2 else rnd.random() for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.0, 0.3, 1 - 0.7, 0.5, 0.99, 1.0):
        assert R.quantile(df, "x", q) == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)


def test_keep_top_share_keeps_ties_and_share(spark):
    vals = [1.0, 2.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s double")
    kept, th = R.keep_top_share(df, "s", 0.7)
    assert th == pytest.approx(float(np.quantile(vals, 0.3)))
    assert kept.count() == sum(v >= th for v in vals) >= 7


def test_evaluate_matches_manual_weighted_f1(spark):
    y = [0, 0, 1, 1, 1, 2, 2, 2, 2, 1]
    p = [0, 1, 1, 1, 0, 2, 2, 1, 2, 2]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    r = evaluate(df, "y", "p").first()
    f1s, ws = [], []
    for c in set(y) | set(p):
        tp = sum(a == c and b == c for a, b in zip(y, p))
        pr = tp / max(sum(b == c for b in p), 1)
        rc = tp / max(sum(a == c for a in y), 1)
        f1s.append(0 if pr + rc == 0 else 2 * pr * rc / (pr + rc))
        ws.append(sum(a == c for a in y))
    assert r.accuracy == pytest.approx(sum(a == b for a, b in zip(y, p)) / len(y))
    assert r.f1_weighted == pytest.approx(sum(f * w for f, w in zip(f1s, ws)) / sum(ws))


def test_class_tfidf_formula(spark):
    occ = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"), ("b", "z"), ("b", "z")]
    df = spark.createDataFrame(occ, "topic string, term string")
    w = {(r.topic, r.term): r.weight for r in TP.class_tfidf(TP.topic_term_counts(df)).collect()}
    tf = pd.DataFrame(occ, columns=["c", "t"]).groupby(["c", "t"]).size().unstack(fill_value=0)
    avg = int(tf.sum(axis=1).mean())
    idf = np.log(avg / tf.sum(axis=0) + 1)
    want = (tf.div(tf.sum(axis=1), axis=0) * idf).stack()
    for (c, t), v in want.items():
        if v > 0:
            assert w[(c, t)] == pytest.approx(v)


def test_topic_similarity_equals_numpy(spark):
    rows = [("a", "x", 0.5), ("a", "y", 0.2), ("b", "y", 0.7), ("b", "z", 0.1), ("c", "x", 0.3), ("c", "z", 0.9)]
    df = spark.createDataFrame(rows, "topic string, term string, weight double")
    got = {(r.topic_a, r.topic_b): r.similarity for r in TP.topic_similarity(df).collect()}
    m = pd.DataFrame(rows, columns=["c", "t", "w"]).pivot(index="c", columns="t", values="w").fillna(0)
    v = m.to_numpy()
    n = np.linalg.norm(v, axis=1)
    sim = v @ v.T / np.outer(n, n)
    for i, a in enumerate(m.index):
        for j, b in enumerate(m.index):
            assert got.get((a, b), 0.0) == pytest.approx(sim[i, j])


def test_nearest_centroid_matches_numpy(spark):
    rnd = np.random.default_rng(7)
    vecs = rnd.normal(size=(60, 8))
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    labels = rnd.integers(0, 4, size=60)
    df = spark.createDataFrame([(i, [float(x) for x in v], int(t)) for i, (v, t) in enumerate(zip(vecs, labels))],
                               "vec_id long, embedding array<double>, topic int")
    cents = TP.centroids(df)
    got = {r.vec_id: r.nearest for r in TP.assign_nearest(df, cents, out="nearest").collect()}
    c = np.stack([vecs[labels == t].mean(axis=0) for t in range(4)])
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    want = (vecs @ c.T).argmax(axis=1)
    assert [got[i] for i in range(60)] == list(want)


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (4, 5), (7, 7)]
    both = edges + [(b, a) for a, b in edges]
    e = spark.createDataFrame(both, "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "node long")
    got = {r.node: r.component for r in TP.connected_components(e, nodes).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}


def test_density_topics_finds_two_blobs_and_noise(spark):
    rnd = np.random.default_rng(3)
    a = rnd.normal(0.0, 0.01, size=(60, 2))
    b = rnd.normal(1.0, 0.01, size=(40, 2))
    noise = np.array([[5.0, 5.0], [-5.0, 5.0]])
    pts = np.vstack([a, b, noise])
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "vec_id long, v array<double>")
    got = {r.vec_id: r.topic for r in density_clusters(df, "v", 5, 10).collect()}
    assert {got[i] for i in range(60)} == {0} and {got[i] for i in range(60, 100)} == {1}
    assert got[100] == -1 and got[101] == -1


def test_company_filters(spark):
    rows = [("Openai", "ORG"), ("Hyundai Motor", "ORG"), ("Acme Inc.", "ORG"), ("Ab", "ORG"), ("Acme", "MISC")]
    df = spark.createDataFrame(rows, "entity_text string, entity_label string")
    assert sorted(r.company for r in companies(df).collect()) == ["Acme", "Hyundai Motor"]


def test_topic_similarity_independent_of_arrow_batches(spark):
    rows = [(f"t{i % 5}", f"w{i % 7}", float(1 + i % 3)) for i in range(35)]
    df = spark.createDataFrame(rows, "topic string, term string, weight double").dropDuplicates(["topic", "term"])
    base = {(r.topic_a, r.topic_b): r.similarity for r in TP.topic_similarity(df).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        small = {(r.topic_a, r.topic_b): r.similarity for r in TP.topic_similarity(df.repartition(1)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert small.keys() == base.keys()
    assert all(small[k] == pytest.approx(base[k]) for k in base)


def test_consecutive_ids_follow_order(spark):
    df = spark.createDataFrame([(i, (i * 7919) % 101) for i in range(300)], "k int, v int").repartition(7)
    got = sorted((r.id, r.v, r.k) for r in A.consecutive_ids(df, [F.col("v").desc(), F.col("k")]).collect())
    assert [g[0] for g in got] == list(range(300))
    assert [(g[1], g[2]) for g in got] == sorted(((v, k) for k, v in [(i, (i * 7919) % 101) for i in range(300)]),
                                               key=lambda t: (-t[0], t[1]))


def test_quantile_is_exact_also_in_tie_blocks(spark):
    rnd = random.Random(11)
    vals = [rnd.random() for _ in range(3000)] + [0.5] * 1500
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.0, 0.1, 0.3, 0.45, 0.5, 0.7, 0.999, 1.0):
        assert R.quantile(df, "x", q, n_bins=16) == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)


@pytest.mark.parametrize("n_bins", [2, 4096])
def test_order_statistics_of_odd_distributions(spark, n_bins):
    """Infinities, both zeros, subnormal and huge numbers, neighbours in the last bit, ties."""
    one = 1.0
    values = [float("-inf"), -1.7e308, -1e-320, -0.0, 0.0, 5e-324, one, np.nextafter(one, 2), np.nextafter(one, 2), 1e300, 1.7e308,
              float("inf"), float("inf")] + [3.5] * 40
    want = sorted(values)
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    for rank in [0, 1, 2, 4, 5, 6, 7, 8, 9, 30, 48, 49, 50, 51, 52]:
        got = R.order_statistics(df, "x", rank, n_bins)
        assert got == (want[rank], want[min(rank + 1, len(want) - 1)]), rank


def test_quantile_ignores_nulls_and_counts_nan_as_largest(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (float("nan"),)], "x double")
    assert R.quantile(df, "x", 0.5) == 2.0 and np.isnan(R.quantile(df, "x", 1.0))
    assert R.quantile(df.filter("x is null"), "x", 0.5) is None


def test_quantile_plan_sorts_no_rows(spark):
    """Every counting pass is an aggregate: nothing is ordered and no limit is taken."""
    df = spark.range(5000).selectExpr("cast(id * id as double) as x")
    seen = []
    collect = type(df).toPandas

    def watched(frame):
        seen.append(frame._jdf.queryExecution().executedPlan().toString())
        return collect(frame)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "toPandas", watched)
        assert R.quantile(df, "x", 0.25) == float(np.quantile(np.arange(5000.0) ** 2, 0.25))
    assert 1 < len(seen) <= 7
    assert not any(word in plan for plan in seen for word in ("TakeOrderedAndProject", "Sort ", "Window"))


def test_token_windows_move_documents_to_their_topic(spark):
    """Two topics with one word each, equal weights: a window of two words, worked by hand."""
    weights = spark.createDataFrame([("a", "apple", 1.0, 0.5), ("b", "berry", 1.0, 0.5)], "topic string, term string, idf double, weight double")
    docs = spark.createDataFrame([(1, "apple apple berry"), (2, "berry"), (3, "cherry pie"), (4, ""), (5, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["topic"]): r["score"] for r in TP.window_topics(docs, weights, "text", ["the"], 2).collect()}
    half = 2 ** -0.5  # windows of document 1: (apple, apple) is all a, (apple, berry) half of each
    assert got == {(1, "a"): pytest.approx(1 + half), (1, "b"): pytest.approx(half), (2, "b"): pytest.approx(1.0)}
