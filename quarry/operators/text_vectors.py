"""Text vectors fitted on the corpus - a randomised truncated SVD of the
TF-IDF matrix.

Terms are hashed to ``BUCKETS`` columns, so the model has that many rows whatever
the corpus.  Texts are split and counted once (:func:`term_counts`).  The subspace is
found by a few passes over the counts: each task adds up its own rows' share of
A'(A Z), the sums meet by range of buckets, and the small square matrices that make
Z orthonormal are worked out on the driver.  A pass multiplies the terms that occur
only, never the dense rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import tokens
from ..sources.writers import materialize

BUCKETS = 1 << 14
DIMS = 64
SPARE = 16      # directions beyond DIMS that the passes carry
PASSES = 4
CELLS = 1 << 20  # tokens or counts, and
BLOCK_ROWS = 4096  # rows, that a task works on at a time
RANGES = 256    # of buckets, by which the tasks' sums meet
TASKS = 4       # a core, that send sums in a pass

_COUNTS = "struct<bucket: binary, times: binary>"


@dataclass(frozen=True)
class TextVectors:
    """``idf`` by bucket, ``components`` (buckets x dims), ``values`` (singular values)."""

    idf: np.ndarray
    components: np.ndarray
    values: np.ndarray

    def save(self, spark: SparkSession, folder: str) -> None:
        """Parquet: one row a bucket, and the singular values."""
        rows = [(i, float(w), c.tolist()) for i, (w, c) in enumerate(zip(self.idf, self.components, strict=True))]
        spark.createDataFrame(rows, "bucket int, idf double, component array<double>").write.mode("overwrite").parquet(os.path.join(folder, "buckets"))
        spark.createDataFrame([(self.values.tolist(),)], "singular_values array<double>").write.mode("overwrite").parquet(os.path.join(folder, "values"))

    @staticmethod
    def load(spark: SparkSession, folder: str) -> TextVectors:
        rows = sorted(spark.read.parquet(os.path.join(folder, "buckets")).collect())
        (values,) = spark.read.parquet(os.path.join(folder, "values")).first()
        return TextVectors(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.array(values))


def term_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of a text's tokens, repeats kept; null texts have none."""
    words = F.coalesce(tokens(text), F.array().cast("array<string>"))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of rows, at most BLOCK_ROWS and about CELLS values each."""
    starts = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    first = 0
    while first < len(sizes):
        last = int(np.searchsorted(starts, starts[first] + CELLS, "right")) - 1
        last = max(first + 1, min(last, first + BLOCK_ROWS))
        yield first, last
        first = last


def _binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive values, so many a row, as a binary column."""
    ends = np.r_[0, np.cumsum(sizes) * values.itemsize].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, how many a row) of a binary column."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, wide)[column.offset:column.offset + len(column) + 1] // np.dtype(kind).itemsize
    flat = np.frombuffer(data, kind)[ends[0]:ends[-1]] if ends[-1] > ends[0] else np.zeros(0, kind)
    return flat, np.diff(ends)


def term_counts(df: DataFrame, text_col: str, out: str = "terms", buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``text_col`` replaced by ``out``: the buckets that occur in the text, ascending, and
    how often (arrays of 32-bit numbers as binaries, half the bytes of parquet lists to read).
    The functions below take this column in the place of the texts."""
    names = [c for c in df.columns if c not in (text_col, out)]
    coded = df.select(*[F.col(f"`{c}`") for c in names], term_buckets(F.col(text_col), buckets).alias("__b"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in coded.drop("__b").schema) + f"`{out}` {_COUNTS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("__b")
            sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            flat, starts = np.asarray(lists.flatten(), np.int64), np.r_[0, np.cumsum(sizes)]
            for first, last in _runs(sizes):
                key = np.repeat(np.arange(last - first) * buckets, sizes[first:last]) + flat[starts[first]:starts[last]]
                pairs, times = np.unique(key.astype(np.int32) if (last - first) * buckets < 1 << 31 else key, return_counts=True)
                met = np.bincount(pairs // buckets, minlength=last - first)
                counts = [_binaries((pairs % buckets).astype(np.int32), met), _binaries(times.astype(np.int32), met)]
                kept = [batch.column(c).slice(first, last - first) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.StructArray.from_arrays(counts, ["bucket", "times"])], names=[*names, out])

    return coded.mapInArrow(run, schema)


def _counted(df: DataFrame, col: str, buckets: int) -> DataFrame:
    """``df`` with ``col`` as term counts: as it is, or counted now if it is text."""
    return df if isinstance(df.schema[col].dataType, StructType) else term_counts(df, col, col, buckets)


def _weighted(column: pa.StructArray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, their buckets, how many a row) of unit-length TF-IDF rows."""
    bucket, times = column.flatten()
    (bucket, sizes), (times, _) = _values(bucket, np.int32), _values(times, np.int32)
    weight = times * idf[bucket]
    row = np.repeat(np.arange(len(sizes)), sizes)
    length = np.sqrt(np.bincount(row, weight * weight, len(sizes)))
    return weight / np.where(length > 0, length, 1)[row], bucket, sizes


def _times(weight: np.ndarray, at: np.ndarray, ends: np.ndarray, z: np.ndarray, out: np.ndarray) -> None:
    """Adds the sparse rows ``weight`` at ``at`` (row i ends at ``ends[i]``) times ``z`` to ``out``."""
    z, first = np.ascontiguousarray(z), 0  # take() would copy any other layout whole for each row
    for i, last in enumerate(ends.tolist()):
        if last > first:
            out[i] += weight[first:last] @ z.take(at[first:last], axis=0)
        first = last


def _collected(batches: Iterator[pa.RecordBatch], col: str, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`_weighted` of several batches together, up to BLOCK_ROWS and CELLS."""
    kept, rows, cells = [], 0, 0
    for batch in batches:
        for first, last in _runs(_values(batch.column(col).flatten()[0], np.int32)[1]):
            kept.append(_weighted(batch.column(col).slice(first, last - first), idf))
            rows, cells = rows + last - first, cells + len(kept[-1][0])
            if rows >= BLOCK_ROWS or cells >= CELLS:
                yield tuple(np.concatenate(x) for x in zip(*kept, strict=True))
                kept, rows, cells = [], 0, 0
    if kept:
        yield tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def _total(rows: DataFrame, shape: tuple[int, int], add: Callable[[np.ndarray, Iterator[pa.RecordBatch]], None]) -> np.ndarray:
    """Sum over the tasks of the matrices that ``add`` fills from their batches: each task
    sends its sums by range of rows, a range is summed in one task, the driver gets each once."""
    ranges = np.array_split(np.arange(shape[0]), min(RANGES, shape[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        add(total, batches)
        for i, r in enumerate(ranges):
            if (part := total[r[0]:r[-1] + 1]).any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()])], names=["part", "s"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, s in zip(batch.column("part").to_pylist(), batch.column("s"), strict=True):
                part = np.frombuffer(s.as_buffer())
                sums[i] = sums[i] + part if i in sums else part.copy()
        for i, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([s.tobytes()])], names=["part", "s"])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.coalesce(TASKS * cores).mapInArrow(run, "part int, s binary")
    out = np.zeros(shape)
    for i, s in parts.repartition(min(len(ranges), 2 * cores), "part").mapInArrow(meet, "part int, s binary").collect():
        out[ranges[i]] = np.frombuffer(s).reshape(-1, shape[1])
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    """A matrix as a column of arrays."""
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


def _orthonormal(z: np.ndarray) -> np.ndarray:
    """Columns made orthonormal; directions that vanish are dropped."""
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    return u[:, s > 1e-12 * max(s.max(initial=0), 1e-300)]


def fit_text_vectors(texts: DataFrame, text_col: str, dims: int = DIMS, buckets: int = BUCKETS, passes: int = PASSES,
                     seed: int = 42) -> TextVectors:
    """Model of all rows of ``texts``.

    idf is ln((1 + n) / (1 + df)) + 1 by bucket; rows of the matrix have unit length, texts
    without a token are zero rows.  With fewer independent texts than ``dims`` the model
    has fewer dimensions.  The start is drawn by ``seed``; sums of doubles may differ
    in the last bits between runs.
    """
    if isinstance(texts.schema[text_col].dataType, StructType):
        counts = texts.select(text_col)
    else:
        counts = materialize(_counted(texts.select(text_col), text_col, buckets), "term_counts")
    n = counts.count()

    def occurs(total: np.ndarray, batches: Iterator[pa.RecordBatch]) -> None:
        for batch in batches:
            total[:, 0] += np.bincount(_values(batch.column(text_col).flatten()[0], np.int32)[0], minlength=buckets)

    idf = np.log((1 + n) / (1 + _total(counts, (buckets, 1), occurs)[:, 0])) + 1

    def share(z: np.ndarray) -> np.ndarray:
        """A'(A Z), row by row and then bucket by bucket."""
        bc = texts.sparkSession.sparkContext.broadcast(np.ascontiguousarray(z))

        def add(total: np.ndarray, batches: Iterator[pa.RecordBatch]) -> None:
            for weight, bucket, sizes in _collected(batches, text_col, idf):
                y = np.zeros((len(sizes), bc.value.shape[1]))
                _times(weight, bucket, np.cumsum(sizes), bc.value, y)
                order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
                row = np.repeat(np.arange(len(sizes)), sizes)[order]
                _times(weight[order], row, np.cumsum(np.bincount(bucket, minlength=buckets)), y, total)

        out = _total(counts, (buckets, z.shape[1]), add)
        bc.unpersist()
        return out

    z = _orthonormal(np.random.default_rng(seed).standard_normal((buckets, min(dims + SPARE, buckets))))
    for _ in range(passes):
        z = _orthonormal(share(z))
        if not z.shape[1]:
            return TextVectors(idf, np.zeros((buckets, 0)), np.zeros(0))
    square, turn = np.linalg.eigh(z.T @ share(z))
    order = np.argsort(-square)[:dims]
    values = np.sqrt(np.maximum(square[order], 0))
    real = values > 1e-9 * values.max(initial=0)
    components = (z @ turn[:, order])[:, real]
    sign = np.sign(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])])
    return TextVectors(idf, components * sign, values[real])


def text_vectors(df: DataFrame, text_col: str, model: TextVectors, out: str = "embedding", unit: bool = True) -> DataFrame:
    """``df`` with each text's vector, ``array<double>``: the unit TF-IDF row times the
    components, scaled to unit length unless it is zero (or ``unit`` is off).  Texts
    need not be those of the fit; a null text has a zero vector.  Term counts in the place
    of the text are not kept."""
    coded = isinstance(df.schema[text_col].dataType, StructType)
    names = [c for c in df.columns if c != out and not (coded and c == text_col)]
    coded = _counted(df.select(*[F.col(f"`{c}`") for c in names], F.col(text_col).alias("__b")), "__b", len(model.idf))
    bc = df.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.drop("__b").schema) + f", `{out}` array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, components = bc.value, np.ascontiguousarray(bc.value.components)
        for batch in batches:
            column = batch.column("__b")
            y = np.zeros((batch.num_rows, m.components.shape[1]))
            for first, last in _runs(_values(column.flatten()[0], np.int32)[1]):
                weight, bucket, sizes = _weighted(column.slice(first, last - first), m.idf)
                _times(weight, bucket, np.cumsum(sizes), components, y[first:last])
            if unit:
                length = np.sqrt((y * y).sum(axis=1, keepdims=True))
                y = y / np.where(length > 0, length, 1)
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, _lists(y)], names=[*names, out])

    return coded.mapInArrow(run, schema)
