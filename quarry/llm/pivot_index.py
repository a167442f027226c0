"""Exact search for the largest inner products by a pivot-distance index.

One extra component makes all vectors equally long (norm M), so that
``|q - x|^2 = |q|^2 + M^2 - 2 <q, x>`` and the largest inner product is the
smallest distance.  Every vector is keyed by its nearest pivot and its distance
to it; sorted by that key, a block of rows is an annulus around a pivot.  A
query starts in its own annulus and in the sample, which give a score that the
k-th best has to reach, and expands to exactly those annuli that the triangle inequality does
not rule out: ``|q - x| >= | |q - p| - |x - p| |``.

The pivots come from a bounded sample; they affect speed, never results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import materialize
from . import vector_blocks as V

SAMPLE = 4096   # vectors that the pivots are fitted on
PIVOTS = 64
SCALE = 256
EXACT = 2.0 ** 53


def fit_pivots(x: np.ndarray, n: int, rounds: int = 6, seed: int = 1) -> np.ndarray:
    """k-means centres of a sample."""
    centres = np.unique(x, axis=0)
    centres = centres[np.random.default_rng(seed).permutation(len(centres))[:n]]
    for _ in range(rounds):
        near = distances(x, centres).argmin(axis=1)
        n_near = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n_near[:, None] > 0, sums / np.maximum(n_near, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * x @ p.T
    return np.sqrt(np.maximum(sq, 0))


def quantise(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, type]:
    """``vec_id, vec`` with floor(SCALE * component), the dimension, the type."""
    vec = F.col(f"`{vec_col}`")
    dtype = V.element_type(vectors, vec_col)
    rows = vectors.filter(V.usable(vec, zero_ok=True) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("x"))
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.floor(SCALE * V.matrix(batch.column("x"), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([v.tobytes() for v in whole.astype(dtype)], pa.binary()),
                 pa.array((whole * whole).sum(1))], names=["vec_id", "vec", "sq"])

    return materialize(rows.mapInArrow(run, "vec_id long, vec binary, sq double"), "pivot_vectors"), dim, dtype


def top_products(vectors: DataFrame, k: int, every: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every``
    divides, the ``k`` other rows with the largest integer inner products of
    floor(256 * component) (all, if there are fewer), ties to the smaller id.

    Rows with a null id or vector, no component, or a null or non-finite one
    take no part; zero vectors do.  Vectors shorter than the longest count as
    padded with zeros.  Rows that repeat an id count once, with their best
    score.  Empty tables give an empty result; other columns are ignored,
    whatever their names.
    """
    rows, dim, dtype = quantise(vectors, id_col, vec_col)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max("sq").alias("m")).first()
    n, longest = stats["n"], stats["m"] or 0.0

    def lifted(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.concatenate([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))[:, None]], axis=1)

    def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        if longest < EXACT:  # sums of whole numbers below 2**53: exact in any order
            return q.astype(np.float64) @ x.T.astype(np.float64)
        return (q.astype(np.int64) @ x.T.astype(np.int64)).astype(np.float64)

    known = V.sample(rows, SAMPLE, dim, dtype)
    pivots = fit_pivots(lifted(known[1]), PIVOTS) if len(known[0]) else np.zeros((1, dim + 1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vec").to_pylist()), dtype).reshape(batch.num_rows, -1)
            d = distances(lifted(x), pivots)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell]), batch.column("vec")],
                names=["vec_id", "cell", "key", "vec"])

    assigned = rows.select("vec_id", "vec").mapInArrow(assign, "vec_id long, cell int, key double, vec binary")
    blocks = V.pack(assigned, n, k, every, product, dtype)
    # The directory of annuli: four numbers for each V.BLOCK vectors.
    annuli = blocks.select("block", "cell", "low", "high").toArrow()
    number, cells = annuli["block"].to_numpy(), annuli["cell"].to_numpy()
    low, high = annuli["low"].to_numpy(), annuli["high"].to_numpy()

    def route(q: np.ndarray, floors: np.ndarray):
        x = q.astype(np.float64)
        sq = (x * x).sum(1)
        # the query's own extra component is 0
        to_pivot = distances(np.concatenate([x, np.zeros((len(x), 1))], axis=1), pivots)
        for j in range(len(number)):
            d = to_pivot[:, cells[j]]
            gap = np.maximum(np.maximum(d - high[j], low[j] - d), 0)
            bound = (sq + longest - gap * gap) / 2
            go = np.flatnonzero(bound + 1e-9 * (sq + longest) + 1e-6 >= floors)
            if len(go):
                yield number[j], go

    found = V.search(blocks, k, route, product, dtype, known)
    return found.withColumn("score", F.col("score").cast("long"))
