"""G1 tagger against all tag paths, and spans worked out by hand."""

from itertools import product

import numpy as np
import pytest

from quarry.operators import tagger as TG


def paths(scores, steps):
    """Score of every tag path of one window."""
    n, k = scores.shape
    return {p: sum(scores[i, t] for i, t in enumerate(p)) + sum(steps[a, b] for a, b in zip(p, p[1:]))
            for p in product(range(k), repeat=n)}


@pytest.mark.parametrize("seed", range(4))
def test_paths_and_chances_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    lengths = np.array([5, 1, 3, 4])
    scores, steps = rng.normal(size=(4, 5, 3)) * 3, rng.normal(size=(3, 3)) * 3
    got = TG.best_paths(scores, lengths, steps)
    _, _, total, chance = TG.forward_backward(scores, lengths, steps)
    for i, n in enumerate(lengths):
        every = paths(scores[i, :n], steps)
        assert tuple(got[i, :n]) == max(every, key=every.get)
        weight = {p: np.exp(v) for p, v in every.items()}
        assert np.isclose(np.exp(total[i]), sum(weight.values()))
        for t in range(n):
            for tag in range(3):
                want = sum(w for p, w in weight.items() if p[t] == tag) / sum(weight.values())
                assert np.isclose(chance[i, t, tag], want)
    assert not chance[1, 1:].any()


def test_gradient_equals_differences():
    rng = np.random.default_rng(5)
    weights, steps = rng.normal(size=(20, 3)), rng.normal(size=(3, 3))
    features, gold = rng.integers(0, 20, (9, TG.FEATURES)), rng.integers(0, 3, 9)
    starts, lengths = np.array([0, 4]), np.array([4, 5])

    def likely(w, s):
        return TG.window_gradient(w, s, features, gold, starts, lengths)[2].sum()

    push, moves, _ = TG.window_gradient(weights, steps, features, gold, starts, lengths)
    by_bucket = np.zeros((20, 3))
    for j in range(TG.FEATURES):
        np.add.at(by_bucket, features[:, j], push)
    for at in [(features[0, 0], 0), (features[4, 2], 1), (features[8, 6], 2)]:
        up = weights.copy()
        up[at] += 1e-6
        assert np.isclose((likely(up, steps) - likely(weights, steps)) / 1e-6, by_bucket[at], atol=1e-4)
    for at in product(range(3), repeat=2):
        up = steps.copy()
        up[at] += 1e-6
        assert np.isclose((likely(weights, up) - likely(weights, steps)) / 1e-6, moves.sum(axis=0)[at], atol=1e-4)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 127, 128, 129, 224, 225, 1000])
def test_kept_parts_of_windows_tile_the_text(n):
    cuts = TG.windows(n)
    assert [i for _, _, a, z in cuts for i in range(a, z)] == list(range(n))
    assert all(first <= a and z <= end and end - first <= TG.WINDOW for first, end, a, z in cuts)


def test_tags_join_to_spans_with_mean_scores():
    names = TG.tag_names(["ORG", "MISC"])
    assert names == ("O", "B-MISC", "I-MISC", "B-ORG", "I-ORG")
    tags = np.array([3, 4, 0, 4, 3, 2, 2, 1])
    chance = np.array([0.5, 1.0, 0.9, 0.25, 0.75, 0.5, 0.0, 1.0])
    assert TG.join_tags(names, tags, chance) == [
        (0, 2, "ORG", 0.75), (3, 4, "ORG", 0.25), (4, 5, "ORG", 0.75), (5, 7, "MISC", 0.25), (7, 8, "MISC", 1.0)]
    assert TG.join_tags(names, np.zeros(3, int), chance[:3]) == [] == TG.join_tags(names, tags[:0], chance[:0])


def test_tokens_shapes_and_gold_tags():
    words, offsets = TG.tokenize("At Acme Corp., 3M")
    assert words == ["At", "Acme", "Corp", ".", ",", "3M"]
    assert offsets.tolist() == [[0, 2], [3, 7], [8, 12], [12, 13], [13, 14], [15, 17]]
    assert [TG.shape(w) for w in words] == ["Xx", "Xx", "Xx", ".", ",", "9X"]
    spans = [{"start": 3, "end": 12, "label": "ORG"}, {"start": 15, "end": 17, "label": "ORG"}]
    assert TG.gold_tags(TG.tag_names(["ORG"]), offsets, spans).tolist() == [0, 1, 2, 0, 0, 1]


EXAMPLES = [("today Acme Corp bought Globex in Paris", [(6, 15, "ORG"), (23, 29, "ORG"), (33, 38, "LOC")]),
            ("in Rome the Initech Group met Acme Corp", [(3, 7, "LOC"), (12, 25, "ORG"), (30, 39, "ORG")]),
            ("nothing stands here", []), (None, None), ("", [])]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(EXAMPLES, f"text string, spans {TG.SPAN_TYPE}")
    return TG.fit_tagger(df, "text", "spans", ["ORG", "LOC"], buckets=512, passes=25)


def test_fitted_tagger_finds_its_spans(spark, fitted, tmp_path):
    model, likely = fitted
    assert likely[-1] > likely[0] and likely[0] == pytest.approx(np.log(1 / 5), abs=1e-6)
    model.save(spark, str(tmp_path / "m"))
    again = TG.Tagger.load(spark, str(tmp_path / "m"))
    assert again.tags == model.tags and (again.weights == model.weights).all() and (again.steps == model.steps).all()
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(EXAMPLES)], "id int, text string, start string")
    got = TG.tag_entities(df, "text", again, keep=["id"]).collect()
    want = {(i, a, z, t[a:z], lab) for i, (t, spans) in enumerate(EXAMPLES) for a, z, lab in spans or []}
    assert {(r.id, r.start, r.end, r.entity_text, r.entity_label) for r in got} == want
    assert all(0.5 < r.score < 1 for r in got)


def test_sums_do_not_depend_on_partitions(spark, fitted):
    df = spark.createDataFrame(EXAMPLES, f"text string, spans {TG.SPAN_TYPE}")
    one = TG.fit_tagger(df.repartition(1), "text", "spans", ["ORG", "LOC"], buckets=512, passes=25)[0]
    assert np.allclose(one.weights, fitted[0].weights, atol=1e-6)


def test_long_texts_are_tagged_whole(spark, fitted):
    """Spans of the windows' overlaps and of the end, also in a text beyond CELLS tokens."""
    text = "today Acme Corp bought Globex in Paris . " * 9000
    df = spark.createDataFrame([(1, text), (2, text[:4100])], "id int, text string")
    got = TG.tag_entities(df, "text", fitted[0], keep=["id"]).groupBy("id", "entity_text").count().collect()
    assert {(r.id, r.entity_text): r["count"] for r in got} == {
        (i, w): n for i, n in ((1, 9000), (2, 100)) for w in ("Acme Corp", "Globex", "Paris")}


def test_empty_fit_tags_nothing(spark):
    none = spark.createDataFrame([], f"text string, spans {TG.SPAN_TYPE}")
    model, likely = TG.fit_tagger(none, "text", "spans", ["ORG"], buckets=64)
    assert likely == [] and not model.weights.any()
    assert TG.tag_entities(spark.createDataFrame([("Acme Corp",)], "text string"), "text", model).count() == 0


def test_spans_are_located_in_order(spark):
    df = spark.createDataFrame([("é Ab, Abc Ab", [("Ab", "MISC"), ("Abc Ab", "ORG")]), ("x", [])],
                               "t string, m array<struct<span:string,label:string>>")
    got = [[tuple(s) for s in r[0]] for r in df.select(TG.spans_in_order("t", "m")).collect()]
    assert got == [[(2, 4, "MISC"), (6, 12, "ORG")], []]


def test_the_entity_stage_takes_a_tagger(spark, fitted, tmp_path):
    from quarry.stages import stage_entities

    rows = [("u1", "d", 0, "t", "Energy", "today Acme Corp bought Globex in Paris", ""),
            ("u2", "d", 0, "t", "Energy", None, "in Rome the Initech Group met Acme Corp")]
    spark.createDataFrame(rows, "url string, date string, topic int, topic_name string, industry_label string, "
                                "title_clean string, text_clean string").write.parquet(str(tmp_path / "in"))
    out = stage_entities(spark, str(tmp_path / "in"), str(tmp_path / "out"), tagger=fitted[0])
    found = spark.read.parquet(out["entities"]).collect()
    assert sorted((r.url, r.entity_text) for r in found) == [
        ("u1", "Acme Corp"), ("u1", "Globex"), ("u2", "Acme Corp"), ("u2", "Initech Group")]
    assert all(0.5 < r.score < 1 for r in found)
    counts = spark.read.csv(out["company_counts"], header=True).collect()
    assert {(r.company, r["count"]) for r in counts} == {("Acme", "2"), ("Globex", "1"), ("Initech", "1")}


def test_spans_are_joined_over_many_plain_tokens():
    names = TG.tag_names(["ORG", "MISC"])
    at = {n: i for i, n in enumerate(names)}
    tags, chance = np.zeros(100_000, np.int8), np.full(100_000, 0.5)
    for first, end, label in ((0, 1, "ORG"), (10, 13, "MISC"), (13, 15, "MISC"), (15, 17, "ORG"), (99_999, 100_000, "ORG")):
        tags[first:end] = at["I-" + label]
        tags[first] = at["B-" + label]
    tags[15] = at["I-ORG"]  # an inside tag after another label opens a span
    class Counted(np.ndarray):
        asked = 0
        def __getitem__(self, key):
            Counted.asked += 1
            return np.asarray(self)[key]
    got = TG.join_tags(names, tags.view(Counted), chance)
    assert got == [(0, 1, "ORG", 0.5), (10, 13, "MISC", 0.5), (13, 15, "MISC", 0.5), (15, 17, "ORG", 0.5), (99_999, 100_000, "ORG", 0.5)]
    assert Counted.asked < 100  # not once a token
