"""A text classifier trained by epochs of mini-batch steps.

Examples become lists of hashed terms, written once by (split, batch), so that a step
reads only its own batch.  In a step each task adds up its rows' share of the gradient
(one row a bucket that it has met), the shares meet by bucket, and the driver moves
weights of a fixed size (Adam with decoupled weight decay).

After each epoch the weights, the optimiser's state and then the validation metrics are
written below one folder; an epoch counts as done once its metrics can be read.  A later
call continues after the last epoch done.  Shares are whole numbers (multiples of
1 / UNIT), so a run that was interrupted ends in the same weights as one that was not,
on whatever partitions.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import left, null_to_empty
from ..sources.writers import scratch_path
from .sentiment import evaluate, label_name
from .text_vectors import term_buckets

BUCKETS = 1 << 15
EPOCHS = 3
BATCHES = 8
RATE = 0.02
DECAY = 0.01
UNIT = 1 << 32
CELLS = 1 << 16  # terms that a task works on at a time

_METRICS = "train_loss double, accuracy double, f1_weighted double, settings string"
_STATE = "bucket int, idf double, weight array<double>, mean array<double>, square array<double>"


@dataclass(frozen=True)
class EpochModel:
    """``idf`` by bucket; ``weights``, buckets (and one row that every text has) x classes."""

    idf: np.ndarray
    weights: np.ndarray


def _groups(lists: pa.Array, idf: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of the unit-length TF-IDF matrix, about CELLS terms at a time: (rows, first entry
    of each row, buckets, values).  Each row begins with the bucket that every text has."""
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    edges = np.r_[0, np.cumsum(sizes)]
    width = len(idf) + 1
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + CELLS, "right")) - 1)
        row = np.repeat(np.arange(last - first), sizes[first:last])
        key, count = np.unique(row * width + flat[edges[first]:edges[last]] + 1, return_counts=True)
        row, bucket = key // width, key % width - 1
        value = (1 + np.log(count)) * idf[bucket]
        value /= np.sqrt(np.bincount(row, value * value, last - first))[row]
        row = np.r_[np.arange(last - first), row]
        order = np.argsort(row, kind="stable")
        starts = np.searchsorted(row[order], np.arange(last - first))
        yield (slice(first, last), starts, np.r_[np.full(last - first, len(idf)), bucket][order],
               np.r_[np.ones(last - first), value][order])
        first = last


def _chances(weights: np.ndarray, starts: np.ndarray, buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
    scores = np.add.reduceat(values[:, None] * weights[buckets], starts, axis=0)
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _terms(text_col: str, buckets: int):
    return term_buckets(left(null_to_empty(text_col), L.SENTIMENT_MAX_CHARS), buckets)


def _batch_gradient(rows: DataFrame, model: EpochModel) -> tuple[np.ndarray, float, int]:
    """Summed gradient of the log loss over ``rows`` (columns b, label), their loss and number."""
    n, k = model.weights.shape
    bc = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bc.value
        total = np.zeros((n + 1, k), np.int64)  # the last row: loss, number of rows
        for batch in batches:
            labels = np.asarray(batch.column("label"), np.int64)
            for at, starts, buckets, values in _groups(batch.column("b"), m.idf):
                chance, want = _chances(m.weights, starts, buckets, values), labels[at]
                each = np.arange(len(want))
                total[n, 0] += np.rint(-np.log(np.maximum(chance[each, want], 1e-300)) * UNIT).astype(np.int64).sum()
                total[n, 1] += len(want)
                chance[each, want] -= 1
                sizes = np.diff(np.r_[starts, len(buckets)])
                push = np.rint(values[:, None] * np.repeat(chance, sizes, axis=0) * UNIT).astype(np.int64)
                order = np.argsort(buckets, kind="stable")
                met, first = np.unique(buckets[order], return_index=True)
                total[met] += np.add.reduceat(push[order], first, axis=0)
        met = np.flatnonzero(total.any(axis=1))
        lists = pa.ListArray.from_arrays(np.arange(len(met) + 1, dtype=np.int32) * k, total[met].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), lists], names=["bucket", "g"])

    parts = rows.select("b", "label").mapInArrow(run, "bucket int, g array<bigint>")
    sums = parts.groupBy("bucket").agg(*[F.sum(F.col("g")[i]).alias(f"g{i}") for i in range(k)])
    got = sums.toPandas().to_numpy(np.int64)  # at most one row a bucket
    bc.unpersist()
    out = np.zeros((n + 1, k), np.int64)
    out[got[:, 0]] = got[:, 1:]
    return out[:n] / UNIT, float(out[n, 0] / UNIT), int(out[n, 1])


def predict(df: DataFrame, model: EpochModel, terms: str = "b") -> DataFrame:
    """``df`` with ``prediction`` (class, ties to the smaller) and ``chance`` in place of its term lists."""
    names = [c for c in df.columns if c != terms]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.drop(terms).schema), "prediction int, chance double"])
    bc = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bc.value
        for batch in batches:
            best, share = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for at, starts, buckets, values in _groups(batch.column(terms), m.idf):
                chance = _chances(m.weights, starts, buckets, values)
                best[at], share[at] = chance.argmax(axis=1), chance.max(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(best), pa.array(share)],
                                             names=[*names, "prediction", "chance"])

    return df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{terms}`")).mapInArrow(run, schema)


def epoch_metrics(spark: SparkSession, folder: str) -> list:
    """Rows of the epochs done in ``folder``, in order: epoch (from 1), train_loss, accuracy, f1_weighted, settings."""
    try:
        return spark.read.schema("epoch int, " + _METRICS).parquet(os.path.join(folder, "metrics")).orderBy("epoch").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _write_state(spark: SparkSession, folder: str, epoch: int, idf: np.ndarray, arrays: list[np.ndarray]) -> None:
    rows = [(i, float(w), *(a[i].tolist() for a in arrays)) for i, w in enumerate([*idf, 1.0])]
    out = spark.createDataFrame(rows, _STATE).coalesce(1)  # one file: there whole or not at all
    out.write.mode("overwrite").parquet(os.path.join(folder, f"state/epoch={epoch}"))


def _write_metrics(spark: SparkSession, folder: str, epoch: int, row: tuple) -> None:
    spark.createDataFrame([row], _METRICS).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, f"metrics/epoch={epoch}"))


def _read_state(spark: SparkSession, folder: str, epoch: int) -> tuple[np.ndarray, list[np.ndarray]]:
    rows = sorted(spark.read.schema(_STATE).parquet(os.path.join(folder, f"state/epoch={epoch}")).collect())
    return np.array([r.idf for r in rows[:-1]]), [np.array([r[i] for r in rows]) for i in (2, 3, 4)]


def best_epoch(metrics: list) -> int:
    """Epoch of the greatest weighted F1 (ties: the earlier); without validation rows the last."""
    judged = [r for r in metrics if r.f1_weighted is not None]
    return max(judged, key=lambda r: (r.f1_weighted, -r.epoch)).epoch if judged else metrics[-1].epoch


def load_best(spark: SparkSession, folder: str) -> EpochModel:
    """G6 + G7: the model of the best epoch done in ``folder``."""
    idf, (weights, _, _) = _read_state(spark, folder, best_epoch(epoch_metrics(spark, folder)))
    return EpochModel(idf, weights)


def train_epochs(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", classes: int = 3,
                 epochs: int = EPOCHS, batches: int = BATCHES, rate: float = RATE, decay: float = DECAY,
                 buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """Trains on the rows of ``df`` with split 'train' until ``epochs`` epochs are done in
    ``folder``, and returns one row an epoch: epoch, train_loss (mean log loss of the steps),
    accuracy and f1_weighted on split 'validation' (null without such rows), best.

    ``label`` is a class from 0; rows with a null label are left out, a null text has no terms.
    Rows are dealt to batches by a hash of their id; the order of batches is drawn for each epoch.
    A folder of other settings, or of another number of training rows, raises ValueError.
    """
    spark = df.sparkSession
    rows = df.filter(F.col("label").isNotNull() & F.col("split").isin("train", "validation")).select(
        F.col("label").cast("int").alias("label"), "split",
        F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(batches)).cast("int").alias("batch"),
        _terms(text_col, buckets).alias("b"))
    path = scratch_path(spark, "epoch_rows")
    rows.hint("rebalance", "split", "batch").write.mode("overwrite").partitionBy("split", "batch").parquet(path)
    data = spark.read.schema("label int, b array<int>, split string, batch int").parquet(path)
    train, valid = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "validation")
    n = train.count()
    settings = json.dumps(dict(rows=n, classes=classes, batches=batches, rate=rate, decay=decay, buckets=buckets, seed=seed))
    done = epoch_metrics(spark, folder)
    if any(r.settings != settings for r in done):
        raise ValueError(f"{folder} holds epochs of other settings: {done[0].settings}, not {settings}")
    if done:
        idf, (weights, mean, square) = _read_state(spark, folder, done[-1].epoch)
    else:
        counts = train.select(F.explode(F.array_distinct("b")).alias("bucket")).groupBy("bucket").count().toPandas()
        found = np.zeros(buckets)
        found[counts["bucket"].to_numpy(np.int64)] = counts["count"].to_numpy()
        idf = np.log((1 + n) / (1 + found)) + 1
        weights, mean, square = (np.zeros((buckets + 1, classes)) for _ in range(3))
    for epoch in range(len(done) + 1, epochs + 1):
        loss, seen = 0.0, 0
        for i, batch in enumerate(np.random.default_rng((seed, epoch)).permutation(batches)):
            total, part, size = _batch_gradient(train.filter(F.col("batch") == int(batch)), EpochModel(idf, weights))
            loss, seen = loss + part, seen + size
            step = (epoch - 1) * batches + i + 1
            g = total / max(size, 1)
            mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
            pull = decay * weights
            pull[-1] = 0  # the row that every text has is not drawn to zero
            weights = weights - rate * (mean / (1 - 0.9 ** step) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8) + pull)
        _write_state(spark, folder, epoch, idf, [weights, mean, square])
        judged = evaluate(predict(valid.select("label", "b"), EpochModel(idf, weights)), "label", "prediction").first()
        _write_metrics(spark, folder, epoch, (loss / max(seen, 1), judged["accuracy"], judged["f1_weighted"], settings))
    done = epoch_metrics(spark, folder)[:epochs]
    best = best_epoch(done) if done else None
    return spark.createDataFrame([(r.epoch, r.train_loss, r.accuracy, r.f1_weighted, r.epoch == best) for r in done],
                                 "epoch int, train_loss double, accuracy double, f1_weighted double, best boolean")


def score_epochs(df: DataFrame, model: EpochModel, text_col: str = "text_clean") -> DataFrame:
    """G3 with such a model: adds ``sentiment`` and ``sentiment_score`` (the class's probability)."""
    out = predict(df.withColumn("__b", _terms(text_col, len(model.idf))), model, "__b")
    return out.withColumns({"sentiment": label_name("prediction"), "sentiment_score": F.col("chance")}).drop("prediction", "chance")
