"""Vector searches against brute force."""

import numpy as np
import pytest

from conftest import SF_MID
from quarry.llm import QUERIES, learned_partitions, pivot_index, vector_blocks

SCHEMA = "vec_id long, embedding array<float>, score string, cell int, rank int"


def vectors(sf):
    import duckdb

    t = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY vec_id").fetchall()
    return np.array([r[0] for r in t]), np.array([r[1] for r in t], np.float64)


def test_recall_and_scores(spark):
    ids, x = vectors(SF_MID)
    rows = QUERIES["op1_learned_partitions"](spark, SF_MID).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, by_rank in found.items():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        want = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        got = [by_rank[k] for k in range(1, 21)]
        assert all(abs(s - scores[ids == i][0]) < 1e-12 for i, s in got)
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
        hits += len(want & {i for i, _ in got})
    assert hits / (20 * len(found)) >= 0.9


def test_query_on_a_table_that_is_not_searched_whole(spark):
    sf = "/root/testdata/sf0.1"
    ids, x = vectors(sf)
    assert len(ids) > learned_partitions.SAMPLE // 8
    found = {}
    for r in QUERIES["op1_learned_partitions"](spark, sf).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert {q: sorted(by_rank) for q, by_rank in found.items()} == {i: list(range(1, 21)) for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, by_rank in found.items():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]].tolist()) & set(by_rank.values()))
    assert hits / (20 * len(found)) >= 0.9


def test_routing_keeps_recall_on_clusters():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 32))
    x = centres[rng.integers(0, 40, 6000)] + 0.3 * rng.standard_normal((6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model, parts, probes = learned_partitions.fit(x[:4096], 40_000, 20)
    assert parts >= 16 and probes <= parts // 2
    home, order = model.ranked(x)[:, 0], model.ranked(x[:200])[:, :probes]
    s = x[:200] @ x.T
    s[np.arange(200), np.arange(200)] = -np.inf
    near = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([np.isin(home[n], o).mean() for n, o in zip(near, order, strict=True)]) >= 0.9


def clustered(n, centres, seed):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((centres, 16))[rng.integers(0, centres, n)] + 0.3 * rng.standard_normal((n, 16))


def hub(n):
    """A third are copies of one longer vector."""
    x = clustered(n, 30, 6)
    x[::3] = 3 * x[0]
    return x


@pytest.mark.parametrize("x", [hub(6000), clustered(1000, 20, 7), clustered(4000, 60, 8)], ids=["hub", "clusters", "more clusters"])
def test_all_queries_have_k_rows(spark, x):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    ranks, hits = {}, 0
    found = learned_partitions.nearest(df, 20, 20).collect()
    for r in found:
        ranks.setdefault(r["query_id"], []).append(r["rank"])
    assert {q: sorted(r) for q, r in ranks.items()} == {q: list(range(1, 21)) for q in range(0, len(x), 20)}
    for q in ranks:
        scores = x @ x[q]
        scores[q] = -np.inf
        level = np.sort(scores)[-20]
        hits += sum(scores[r["vec_id"]] >= level - 1e-9 for r in found if r["query_id"] == q)
    assert hits / (20 * len(ranks)) >= 0.9


@pytest.mark.parametrize("scale", [1e-8, 1e8])
def test_scores_are_exact_at_any_scale(spark, monkeypatch, scale):
    """All parts probed, so that the result must be the exact one."""
    monkeypatch.setattr(learned_partitions, "TARGET", 2.0)
    x = clustered(400, 10, 11) * scale
    x[50:90] = x[50]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in learned_partitions.nearest(df, 20, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 400, 20):
        s = np.array([sum(a * b for a, b in zip(v, x[q])) for v in x])
        s[50:90] = s[50]
        s[q] = -np.inf
        order = np.lexsort((np.arange(400), -s))[:20]
        want = [(k + 1, i) for k, i in enumerate(order.tolist())]
        assert [g[:2] for g in sorted(got[q])] == want
        assert np.allclose([g[2] for g in sorted(got[q])], s[order], rtol=1e-13, atol=0)


@pytest.mark.parametrize("scale", [1e-8, 1e8])
def test_routing_keeps_recall_at_any_scale(spark, scale):
    x = clustered(400, 10, 11) * scale
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = {}
    for r in learned_partitions.nearest(df, 20, 20).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    near = [set(np.argsort(-np.where(np.arange(400) == q, -np.inf, x @ x[q]))[:20].tolist()) for q in found]
    assert len(found) == 20 and all(len(v) == 20 for v in found.values())
    assert sum(len(a & set(v)) for a, v in zip(near, found.values(), strict=True)) >= 0.9 * 400


@pytest.mark.parametrize("kind", ["clusters", "hub"])
def test_routed_rows_reach_recall_where_parts_are_skipped(spark, monkeypatch, kind):
    """20,000 rows: fewer than all (query, block) pairs are visited, the rows found there alone reach the recall."""
    x = clustered(20_000, 50, 13)
    if kind == "hub":
        x[::3] = 3 * x[0]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    visited = []
    search = vector_blocks.search

    def counted(blocks, k, route, product, dtype, known, meets=None):
        some = x[::200]
        pairs = [(b, len(q)) for b, q in route(some, None)]
        visited.append(sum(n for _, n in pairs) / (len(some) * blocks.count()))
        return search(blocks, k, route, product, dtype, known, meets)

    monkeypatch.setattr(vector_blocks, "search", counted)
    found = {}
    for r in learned_partitions.nearest(df, 20, 20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {q: sorted(k for k, _ in v) for q, v in found.items()} == {q: list(range(1, 21)) for q in range(0, 20_000, 20)}
    hits = 0
    for q, got in found.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += (s[[i for _, i in got]] >= np.sort(s)[-20] - 1e-9).sum()
    assert visited[0] < 0.75 and hits / (20 * len(found)) >= 0.9, (visited, hits / (20 * len(found)))


def test_blocks_without_queries(spark):
    x = clustered(700, 12, 9).tolist()
    df = spark.createDataFrame([(20 * i + (i > 0), v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert sorted((r["query_id"], r["rank"]) for r in learned_partitions.nearest(df, 20, 20).collect()) == [(0, k) for k in range(1, 21)]


def test_parts_are_balanced():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1000, 16))
    label = learned_partitions.balanced_parts(1000, *learned_partitions.neighbour_graph(x, 10), 8)
    assert np.bincount(label).tolist() == [125] * 8


def test_pivot_search_with_small_blocks(spark, monkeypatch):
    """Many blocks, a hot vector, lengths that differ: same as brute force."""
    monkeypatch.setattr(vector_blocks, "BLOCK", 40)
    monkeypatch.setattr(vector_blocks, "PART_ROWS", 90)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 8)).astype(np.float32) * rng.uniform(0.1, 3, (900, 1)).astype(np.float32)
    x[100:400] = x[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in pivot_index.top_products(df, k=5, every=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    for q in range(0, 900, 7):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(900), -s)).tolist() if i != q][:5]
        assert sorted(got[q]) == [(k + 1, i, int(s[i])) for k, i in enumerate(order)]


def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (100, [0.9, -0.1]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0]), (20, [0.5, 0.5]), (8, [0.5, 0.5])]
    return spark.createDataFrame([(i, v, "s", 1, 2) for i, v in rows], SCHEMA)


def test_odd_vectors(spark):
    ann = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 6)) for r in learned_partitions.nearest(odd(spark), 20, 20).collect()}
    assert ann[0, 1] == (7, 1.0) and ann[0, 2] == (100, 0.9) and ann[0, 3] == (8, 0.5) and ann[0, 4] == (20, 0.5)
    assert {q for q, _ in ann} == {0, 20, 100} and (0, 5) not in ann
    top = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in pivot_index.top_products(odd(spark), 5, 50).collect()}
    assert {q for q, _ in top} == {0, 100}
    assert top[0, 1] == (7, 65536) and top[0, 3] == (8, 32768) and top[0, 5] == (6, 0)
    empty = spark.createDataFrame([], SCHEMA)
    assert learned_partitions.nearest(empty, 20, 20).count() == 0 and pivot_index.top_products(empty, 5, 50).count() == 0
