"""Hierarchical density clusters against a brute-force version on the complete
graph, in one block and in many, and membership of unseen rows."""

import numpy as np
import pytest

from quarry.operators import density as DN
from quarry.operators import text_vectors as TV
from pyspark.sql import functions as F


def brute_force(x, min_samples, min_cluster_size):
    """Labels by sorting all pairs, top-down condensation and excess of mass."""
    n = len(x)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(dist, axis=1)[:, min(min_samples, n - 1)]
    reach = np.maximum(dist, np.maximum(core[:, None], core[None]))
    a, b = np.triu_indices(n, 1)
    home, members, halves = np.arange(n), {i: [i] for i in range(n)}, {}
    top = 0
    for k in np.lexsort((b, a, reach[a, b])):
        p, q = home[a[k]], home[b[k]]
        if p != q:
            top = n + len(halves)
            halves[top], members[top] = (p, q, 1 / max(reach[a[k], b[k]], DN.NEAREST)), members[p] + members[q]
            home[members[top]] = top

    def grown(node, birth):
        """(worth, chosen clusters) of the cluster that begins at ``node``."""
        worth, own = 0.0, members[node]
        while True:
            p, q, level = halves[node]
            small = [len(members[c]) < min_cluster_size for c in (p, q)]
            if not any(small):
                worth += len(members[node]) * (level - birth)
                parts = grown(p, level), grown(q, level)
                below = parts[0][0] + parts[1][0]
                return (worth, [own]) if worth >= below else (below, parts[0][1] + parts[1][1])
            gone = [c for c, s in zip((p, q), small) if s]
            worth += sum(len(members[c]) for c in gone) * (level - birth)
            if all(small):
                return worth, [own]
            node = q if small[0] else p

    labels, node = np.full(n, -1), top
    while node in halves:
        p, q, level = halves[node]
        big = [c for c in (p, q) if len(members[c]) >= min_cluster_size]
        if len(big) == 2:
            chosen = grown(p, level)[1] + grown(q, level)[1]
            for t, m in enumerate(sorted(chosen, key=lambda m: (-len(m), min(m)))):
                labels[m] = t
        if len(big) != 1:
            break
        node = big[0]
    return labels


def planted(seed, d):
    """Clusters of unlike size and density, and noise."""
    rnd = np.random.default_rng(seed)
    parts = [rnd.normal(rnd.uniform(-4, 4, d), spread, (size, d)) for size, spread in ((90, 0.05), (50, 0.4), (110, 0.15), (30, 0.02))]
    x = np.concatenate([*parts, rnd.uniform(-6, 6, (30, d))])
    rnd.shuffle(x)
    return x


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>").repartition(3)


def labels(df):
    return np.array([r.topic for r in df.orderBy("vec_id").collect()])


@pytest.mark.parametrize("seed, block, sweep", [(1, 4096, 1 << 20), (2, 150, 100)])
def test_clusters_equal_brute_force(spark, monkeypatch, seed, block, sweep):
    monkeypatch.setattr(DN, "BLOCK_VALUES", block)  # several blocks, several Boruvka rounds
    monkeypatch.setattr(DN, "SWEEP_EDGES", sweep)   # several sweeps, doubled pointers
    x = planted(seed, 2 + seed % 2)
    want = brute_force(x, 5, 20)
    assert len(set(want)) > 3 and (want == -1).any()
    got = DN.density_clusters(frame(spark, x), "v", 5, 20).collect()
    assert [r.topic for r in sorted(got)] == want.tolist()
    assert all((r.strength == 0) == (r.topic == -1) and 0 <= r.strength <= 1 for r in got)
    assert {r.topic for r in got if r.strength == 1} == set(want) - {-1}


def test_certain_edges_are_a_part_of_the_tree():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(60, 2))
    core, v = np.zeros(60), np.arange(60)
    whole = {(w, min(v[a], v[b]), max(v[a], v[b])) for w, a, b in DN._local_tree(x, core, v)}
    comp, kept = DN._sure_edges(x, core, v, np.full(60, np.inf))
    assert set(kept) == whole and set(comp) == {0}
    left = x[:, 0] <= 0
    for half, other in ((left, ~left), (~left, left)):
        out = np.sqrt(((x[half][:, None] - x[other][None]) ** 2).sum(-1)).min(axis=1)
        comp, kept = DN._sure_edges(x[half], core[half], v[half], out)
        assert set(kept) <= whole and 0 < len(kept) < half.sum()
        assert len(set(comp)) == half.sum() - len(kept)


def test_copies_nulls_and_empty_tables(spark):
    x = planted(3, 2)
    copies = np.concatenate([x, np.repeat([[9.0, 9.0]], 120, axis=0)])  # a third are one vector
    df = frame(spark, copies).unionByName(spark.createDataFrame(
        [(1000, None), (1001, []), (1002, [None, 1.0]), (1003, [float("nan"), 0.0])], "vec_id long, v array<double>"))
    got = {r.vec_id: r.topic for r in DN.density_clusters(df, "v", 5, 20).collect()}
    assert len(got) == len(copies) + 4 and {got[i] for i in range(1000, 1004)} == {-1}
    assert len({got[i] for i in range(len(x), len(copies))}) == 1 and got[len(x)] >= 0
    assert got[len(x)] not in {got[i] for i in range(len(x))}
    assert DN.density_clusters(df.filter("vec_id > 1002"), "v", 5, 20).collect()[0].topic == -1
    assert DN.density_clusters(df.filter("false"), "v", 5, 20).collect() == []
    assert {r.topic for r in DN.density_clusters(df.filter("vec_id < 15"), "v", 5, 20).collect()} == {-1}


def test_members_rejoin_and_strength_falls_with_distance(spark, monkeypatch):
    monkeypatch.setattr(DN, "BLOCK_VALUES", 150)
    x = planted(0, 2)
    df = frame(spark, x)
    fit = DN.fit_density(df, "v", 5, 20)
    own = labels(DN.density_clusters(df, "v", 5, 20))
    again = {r.vec_id: r for r in DN.attach_to_clusters(df, fit, "v", 5).collect()}
    inside = np.flatnonzero(own >= 0)
    assert np.mean([again[i].topic == own[i] for i in inside]) > 0.97
    centre = x[own == 0].mean(axis=0)
    steps = [0.0, 0.3, 0.6, 1.0, 40.0]
    away = spark.createDataFrame([(i, (centre + [s, 0]).tolist()) for i, s in enumerate(steps)] + [(9, None)], "vec_id long, v array<double>")
    got = {r.vec_id: r for r in DN.attach_to_clusters(away, fit, "v", 5).collect()}
    strength = [got[i].strength for i in range(len(steps))]
    assert got[0].topic == 0 and strength == sorted(strength, reverse=True)
    assert got[4].topic == got[9].topic == -1 and got[4].strength == got[9].strength == 0
    assert {r.topic for r in DN.attach_to_clusters(away, fit.filter("false"), "v", 5).collect()} == {-1}


# --- fitted text vectors ------------------------------------------------------

TEXTS = [" ".join(np.random.default_rng(i).choice([f"t{k}" for k in range(i % 3 * 20, i % 3 * 20 + 30)], 40)) for i in range(90)]


def test_text_vectors_come_within_a_percent_of_an_exact_svd(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None, "", "!"])], "i int, t string").repartition(5)
    model = TV.fit_text_vectors(df, "t", dims=12, buckets=256)
    counts = np.zeros((93, 256))
    for i, buckets in df.select("i", TV.term_buckets(F.col("t"), 256)).collect():
        np.add.at(counts[i], buckets, 1)
    a = counts * (np.log(94 / (1 + (counts > 0).sum(axis=0))) + 1)
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    exact = np.linalg.svd(a, compute_uv=False)
    best = np.sqrt((exact[12:] ** 2).sum())
    assert np.linalg.norm(a - a @ model.components @ model.components.T) < 1.01 * best
    assert np.allclose(model.values[:4], exact[:4], rtol=1e-3)
    assert np.allclose(model.components.T @ model.components, np.eye(12))
    got = {r.i: r.embedding for r in TV.text_vectors(df, "t", model, unit=False).collect()}
    assert np.allclose([got[i] for i in range(93)], a @ model.components)
    model.save(spark, str(tmp_path / "m"))
    back = TV.TextVectors.load(spark, str(tmp_path / "m"))
    assert (back.components == model.components).all() and (back.idf == model.idf).all() and (back.values == model.values).all()


def test_unit_vectors_and_degenerate_corpora(spark):
    df = spark.createDataFrame([(0, "one two three"), (1, "one two three"), (2, None)], "i int, t string")
    model = TV.fit_text_vectors(df, "t", dims=12, buckets=64)
    assert model.components.shape[1] == 1  # one direction only
    got = {r.i: r.embedding for r in TV.text_vectors(df, "t", model).collect()}
    assert np.allclose(np.abs(got[0]), [1]) and got[0] == got[1] and got[2] == [0.0]
    assert TV.fit_text_vectors(df.filter("i = 2"), "t", buckets=64).components.shape[1] == 0


def test_counted_texts_stand_for_texts(spark, monkeypatch):
    """Counts made once serve the fit and the vectors; equal texts have equal vectors in any batch."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None, "", "a b", *TEXTS[::-7]])], "i int, t string").repartition(5)
    want = {r.i: r.embedding for r in TV.text_vectors(df, "t", TV.fit_text_vectors(df, "t", dims=12, buckets=256)).collect()}
    counted = TV.term_counts(df, "t", buckets=256)
    monkeypatch.setattr(TV, "term_buckets", None)  # no text is split again
    monkeypatch.setattr(TV, "CELLS", 100)
    model = TV.fit_text_vectors(counted, "terms", dims=12, buckets=256)
    got = TV.text_vectors(counted, "terms", model)
    assert got.columns == ["i", "embedding"]
    got = {r.i: r.embedding for r in got.collect()}
    assert all(np.allclose(got[i], want[i]) for i in want) and len(got) == len(want)
    assert all(got[len(TEXTS) + 3 + k] == got[TEXTS.index(t)] for k, t in enumerate(TEXTS[::-7]))


def test_sweep_hands_its_rows_on_in_bounded_frames(monkeypatch):
    monkeypatch.setattr(DN, "SWEEP_ROWS", 10)
    run = DN._Sweep(2)
    for label in range(60):
        run.add(label, 1, None, 0.0, 0.0)
    for a in range(0, 60, 2):
        run.merge(f"e{a}", a, a + 1, 1.0)
    frames = list(run.written())
    assert [len(f) for f in frames] == [10] * 6 and not run.rows
    assert sorted(int(v) for f in frames for v in f["label"]) == list(range(60))
    assert len(run.state) == 30  # summaries of merged components are let go


def test_points_are_packed_into_blocks_once(spark, monkeypatch):
    """Rounds of the spanning tree carry names of components, not the points; the tree is that of all pairs."""
    monkeypatch.setattr(DN, "BLOCK_VALUES", 150)
    packed, whole = [], DN._packed
    monkeypatch.setattr(DN, "_packed", lambda df, columns: packed.append(columns) or whole(df, columns))
    x = planted(2, 2)
    points, n, d = DN._points(frame(spark, x), "v", "vec_id")
    points = spark.createDataFrame(DN.core_distances(points, 5, n, d).toPandas())
    rows = points.orderBy("v").collect()
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    at = [int(np.flatnonzero((x == r.x).all(axis=1))[0]) for r in rows]
    core = np.sort(dist, axis=1)[:, 5]
    assert np.allclose([r.core for r in rows], core[at], rtol=1e-12)
    tree = DN.spanning_tree(points, d).collect()
    assert packed == [["v", "m"], ["v", "core"]]
    reach = np.maximum(dist, np.maximum(core[:, None], core[None]))[np.ix_(at, at)]
    want = DN._local_tree(x[at], core[at], np.arange(n))
    assert len(tree) == n - 1 and np.allclose(sorted(e.w for e in tree), [e[0] for e in want], rtol=1e-12)
    assert all(np.isclose(reach[e.lo, e.hi], e.w, rtol=1e-12) for e in tree)


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_pairs_within_a_bound_are_exact(shift):
    rnd = np.random.default_rng(8)
    x, y = rnd.normal(shift, 1e-3, (700, 3)), rnd.normal(shift, 1e-3, (90, 3))
    dist = DN._distances(x, y)
    bound = np.sort(dist, axis=1)[:, 4] * np.tile([1.0, 0.0, np.inf, 0.5], 175)
    i, j, got = DN._within(x, y, bound)
    assert sorted(zip(i.tolist(), j.tolist())) == [tuple(p) for p in np.argwhere(dist <= bound[:, None]).tolist()]
    assert (got == dist[i, j]).all()


def test_block_tree_measures_its_distances_once(monkeypatch):
    """A block's distances are worked out together; equal weights are still taken by ids."""
    rnd = np.random.default_rng(5)
    x, core, v = rnd.integers(0, 5, (80, 2)).astype(float), rnd.choice([0.0, 1.0, 1.5], 80), rnd.permutation(200)[:80]
    calls, distances = [], DN._distances
    monkeypatch.setattr(DN, "_distances", lambda a, b: calls.append(len(a)) or distances(a, b))
    got = {(w, min(v[a], v[b]), max(v[a], v[b])) for w, a, b in DN._local_tree(x, core, v)}
    assert calls == [80]
    reach = np.maximum(distances(x, x), np.maximum(core[:, None], core))
    home, want = {int(i): int(i) for i in v}, set()
    for w, a, b in sorted((reach[i, j], min(v[i], v[j]), max(v[i], v[j])) for i in range(80) for j in range(i)):
        if home[a] != home[b]:
            want.add((w, a, b))
            old, new = home[a], home[b]
            home = {k: new if h == old else h for k, h in home.items()}
    assert got == want
    monkeypatch.setattr(DN, "WHOLE_ROWS", 10)  # row by row, the same
    assert {(w, min(v[a], v[b]), max(v[a], v[b])) for w, a, b in DN._local_tree(x, core, v)} == want
