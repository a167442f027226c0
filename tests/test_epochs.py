"""Training by epochs, interrupted and not, against dense steps in numpy."""

import numpy as np
import pytest

from quarry.operators import epochs as EP

WORDS = {0: "awful broken bad", 1: "table chair window", 2: "great lovely good"}
ROWS = [(i, f"{WORDS[i % 3].split()[i // 3 % 3]} {WORDS[i % 3].split()[i // 9 % 3]} thing number{i % 7}", i % 3,
         "validation" if i % 5 == 0 else "test" if i % 11 == 0 else "train") for i in range(150)]
ROWS += [(900, None, 1, "train"), (901, "", 2, "train"), (902, "unlabelled", None, "train"), (0, "good good", 2, "train")]
SCHEMA = "doc_id long, text string, label int, split string"
OPTIONS = dict(buckets=256, batches=3, rate=0.1)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("whole"))
    table = EP.train_epochs(spark.createDataFrame(ROWS, SCHEMA), folder, epochs=4, **OPTIONS).collect()
    return folder, table


def test_one_row_an_epoch_and_the_best_is_loaded(spark, whole):
    folder, table = whole
    assert [r.epoch for r in table] == [1, 2, 3, 4]
    assert table[0].train_loss > table[-1].train_loss
    top = max(r.f1_weighted for r in table)
    assert [r.epoch for r in table if r.best] == [min(r.epoch for r in table if r.f1_weighted == top)] and top > 0.95
    best = EP.load_best(spark, folder)
    idf, (weights, _, _) = EP._read_state(spark, folder, EP.best_epoch(EP.epoch_metrics(spark, folder)))
    assert (best.weights == weights).all() and (best.idf == idf).all()


@pytest.mark.parametrize("lost", ["_write_state", "_write_metrics"])
def test_an_interrupted_run_ends_in_the_same_model(spark, whole, tmp_path, monkeypatch, lost):
    """The driver goes before epoch 2 is written, or between its weights and its metrics."""
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(7)
    write = getattr(EP, lost)

    def fail(spark, folder, epoch, *rest):
        if epoch == 2:
            raise RuntimeError("driver lost")
        write(spark, folder, epoch, *rest)

    monkeypatch.setattr(EP, lost, fail)
    with pytest.raises(RuntimeError):
        EP.train_epochs(df, str(tmp_path), epochs=4, **OPTIONS)
    monkeypatch.undo()
    assert [r.epoch for r in EP.epoch_metrics(spark, str(tmp_path))] == [1]
    assert EP.train_epochs(df.repartition(2), str(tmp_path), epochs=4, **OPTIONS).collect() == whole[1]
    for a, b in zip(EP._read_state(spark, str(tmp_path), 4)[1], EP._read_state(spark, whole[0], 4)[1]):
        assert (a == b).all()


def test_other_settings_are_refused(spark, whole):
    with pytest.raises(ValueError, match="other settings"):
        EP.train_epochs(spark.createDataFrame(ROWS, SCHEMA), whole[0], epochs=5, **{**OPTIONS, "rate": 0.2})


def test_gradient_equals_dense_numpy(spark):
    rng = np.random.default_rng(3)
    model = EP.EpochModel(rng.random(16) + 0.5, rng.normal(size=(17, 3)))
    lists = [rng.integers(0, 16, n).tolist() for n in (5, 0, 1, 40)]
    labels = [0, 2, 1, 2]
    rows = spark.createDataFrame(list(zip(lists, labels)), "b array<int>, label int").repartition(3)
    x = np.zeros((4, 17))
    for i, b in enumerate(lists):
        for j, c in zip(*np.unique(b, return_counts=True)):
            x[i, int(j)] = (1 + np.log(c)) * model.idf[int(j)]
        x[i] /= np.linalg.norm(x[i]) or 1
    x[:, 16] = 1
    e = np.exp(x @ model.weights)
    p = e / e.sum(axis=1, keepdims=True)
    got, loss, n = EP._batch_gradient(rows, model)
    assert n == 4 and np.isclose(loss, -np.log(p[range(4), labels]).sum())
    assert np.allclose(got, x.T @ (p - np.eye(3)[labels]), atol=1e-7)
    back = EP.predict(rows, model).collect()
    assert sorted((r.label, r.prediction) for r in back) == sorted(zip(labels, p.argmax(axis=1)))


def test_scores_carry_the_callers_columns(spark, whole):
    df = spark.createDataFrame([("lovely great thing", "b"), (None, "x"), ("awful bad", "y")], "text_clean string, b string")
    got = {r.b: r for r in EP.score_epochs(df, EP.load_best(spark, whole[0])).collect()}
    assert got["b"].sentiment == "positive" and got["y"].sentiment == "negative"
    assert set(got) == {"b", "x", "y"} and all(0 < r.sentiment_score < 1 for r in got.values())


def test_no_rows_train_nothing(spark, tmp_path):
    got = EP.train_epochs(spark.createDataFrame([], SCHEMA), str(tmp_path), epochs=2, **OPTIONS).collect()
    assert [(r.epoch, r.train_loss, r.f1_weighted, r.best) for r in got] == [(1, 0.0, None, False), (2, 0.0, None, True)]
