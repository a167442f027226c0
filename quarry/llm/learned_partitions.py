"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the graph of nearest neighbours, cut by recursive
bisection into parts of equal size that sever few edges, then a small
classifier (one hidden layer) from vector to part.  The classifier places every
row of the table, and routes a query to its most probable parts, whose rows are
reranked by the exact measure.  How many parts are probed is calibrated on
sample queries that the classifier was not fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import materialize
from . import vector_blocks as V

SAMPLE = 4096        # vectors that graph and classifier are fitted on
NEIGHBOURS = 10      # edges of a vector in the graph
PART_ROWS = 1536     # rows of a part aimed at, between MIN_PARTS and MAX_PARTS
MIN_PARTS, MAX_PARTS = 4, 64
HIDDEN, EPOCHS, BATCH, RATE = 128, 15, 256, 3e-3
TARGET = 0.94        # recall aimed at on the calibration queries


def neighbour_graph(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of each row's k largest inner products, both ways."""
    n, k = len(x), min(k, len(x) - 1)
    to = np.zeros((n, k), np.int64)
    for a in range(0, n, 1024):
        s = x[a:a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        to[a:a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    src = np.repeat(np.arange(n), k)
    return np.concatenate([src, to.ravel()]), np.concatenate([to.ravel(), src])


def bisect(nodes: np.ndarray, src: np.ndarray, dst: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Halves of equal size: the median of a slow vector of the graph's random
    walk, then rounds that swap the nodes with most edges on the other side."""
    n = len(nodes)
    degree = np.maximum(np.bincount(src, minlength=n), 1)
    v = rng.standard_normal(n)
    for _ in range(80):
        v -= (v * degree).sum() / degree.sum()
        v = (v + np.bincount(src, weights=v[dst], minlength=n) / degree) / 2
        v /= np.abs(v).max() or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(8):
        across = np.bincount(src, weights=(side[src] != side[dst]).astype(float), minlength=n)
        gain = 2 * across - np.bincount(src, minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        swap = np.flatnonzero(gain[left[:m]] + gain[right[:m]] > 0)
        swap = swap[:max(1, len(swap) // 2)] if len(swap) else swap
        if not len(swap):
            break
        side[left[swap]], side[right[swap]] = True, False
    return side


def balanced_parts(n: int, src: np.ndarray, dst: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """Part of each node; ``parts`` is a power of two."""
    rng = np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    count = 1
    while count < parts:
        new = label * 2
        for p in range(count):
            nodes = np.flatnonzero(label == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inner = (place[src] >= 0) & (place[dst] >= 0)
            if len(nodes) > 1:
                new[nodes] += bisect(nodes, place[src[inner]], place[dst[inner]], rng)
        label, count = new, count * 2
    return label


class Classifier:
    """Softmax over parts with one hidden layer, fitted by Adam."""

    def __init__(self, x: np.ndarray, y: np.ndarray, parts: int, seed: int = 2):
        rng = np.random.default_rng(seed)
        self.scale = 1 / max(1e-12, float(np.sqrt((x * x).mean())))
        shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
        self.w = [rng.standard_normal(s) * np.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s) for s in shapes]
        m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), BATCH):
                i = order[a:a + BATCH]
                h, p = self._forward(x[i])
                p[np.arange(len(i)), y[i]] -= 1
                p /= len(i)
                back = (p @ self.w[2].T) * (h > 0)
                grads = [(x[i] * self.scale).T @ back, back.sum(0), h.T @ p, p.sum(0)]
                step += 1
                for w, g, a1, a2 in zip(self.w, grads, m, v, strict=True):
                    a1 += 0.1 * (g - a1)
                    a2 += 0.001 * (g * g - a2)
                    w -= RATE * (a1 / (1 - 0.9 ** step)) / (np.sqrt(a2 / (1 - 0.999 ** step)) + 1e-8)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x * self.scale @ self.w[0] + self.w[1], 0)
        z = h @ self.w[2] + self.w[3]
        z = np.exp(z - z.max(1, keepdims=True))
        return h, z / z.sum(1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts, the most probable first."""
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")


def probes_needed(model: Classifier, x: np.ndarray, queries: np.ndarray, parts: int, k: int) -> int:
    """Fewest probes whose parts hold TARGET of the queries' k nearest."""
    home = model.ranked(x)[:, 0]
    order = model.ranked(x[queries])
    place = np.argsort(order, axis=1)  # position of each part in a query's order
    s = x[queries] @ x.T
    s[np.arange(len(queries)), queries] = -np.inf
    near = np.argsort(-s, axis=1)[:, :k]
    depth = np.take_along_axis(place, home[near], 1)
    for n in range(1, parts):
        if (depth < n).mean() >= TARGET:
            return n
    return parts


def fit(x: np.ndarray, n_rows: int, k: int) -> tuple[Classifier, int, int]:
    """Classifier, number of parts, probes."""
    parts = 1 << max(0, round(np.log2(max(1, n_rows / PART_ROWS))))
    parts = int(min(max(parts, MIN_PARTS), MAX_PARTS))
    while parts > 1 and len(x) < 4 * parts:
        parts //= 2
    held = np.arange(0, len(x), 8)
    train = np.setdiff1d(np.arange(len(x)), held) if len(x) >= 64 else np.arange(len(x))
    if parts > 1:
        label = balanced_parts(len(train), *neighbour_graph(x[train], NEIGHBOURS), parts)
    else:
        label = np.zeros(len(train), np.int64)
    model = Classifier(x[train], label, parts)
    # neighbours in the sample are farther than in the table: a cautious estimate
    return model, parts, probes_needed(model, x, held, parts, min(k, max(1, len(x) - 1)))


def nearest(vectors: DataFrame, k: int, every: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every``
    divides, the ``k`` other rows with the largest inner product found (all, if
    there are at most ``k``), nearest first, ties to the smaller id.  Candidates
    are the rows of the probed parts and of the query's own block; parts are
    probed until they hold more than ``k`` rows.

    ``score`` is the inner product of the original vectors in doubles, added up in
    one order for all pairs.  Rows
    with a null id or vector, a zero vector, no component, or a null or
    non-finite one take no part.  Vectors shorter than the longest count as
    padded with zeros.  Rows that repeat an id count once.  Empty tables give an empty result; other
    columns are ignored, whatever their names.
    """
    vec = F.col(f"`{vec_col}`")
    dtype = V.element_type(vectors, vec_col)
    rows = vectors.filter(V.usable(vec, zero_ok=False) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("x"))
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim")).first()
    n, dim = stats["n"], stats["dim"] or 0

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = V.matrix(batch.column("x"), dim).astype(dtype)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([v.tobytes() for v in x], pa.binary())],
                                             names=["vec_id", "vec"])

    def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        # einsum adds up every pair in one order, so that equal vectors tie wherever
        # they lie (a matrix product's order follows the matrices' shapes)
        return np.einsum("ij,kj->ik", q.astype(np.float64), x.astype(np.float64))

    packed = materialize(rows.mapInArrow(raw, "vec_id long, vec binary"), "ann_vectors")
    known = V.sample(packed, SAMPLE, dim, dtype)
    model, parts, probes = fit(known[1].astype(np.float64), n, k) if len(known[0]) else (None, 1, 1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vec").to_pylist()), dtype).reshape(batch.num_rows, -1)
            part = model.ranked(x.astype(np.float64))[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(part.astype(np.int32)), pa.array(np.zeros(len(part))), batch.column("vec")],
                names=["vec_id", "cell", "key", "vec"])

    assigned = packed.mapInArrow(assign, "vec_id long, cell int, key double, vec binary")
    blocks = V.pack(assigned, n, k, every, product, dtype)
    # The directory: three numbers for each V.BLOCK vectors.
    directory = blocks.select("block", "cell", (F.length("ids") / 8).cast("long").alias("n")).toArrow()
    number, cells = directory["block"].to_numpy(), directory["cell"].to_numpy()
    sizes = np.bincount(cells, weights=directory["n"].to_numpy(), minlength=parts)

    def probed(q: np.ndarray) -> np.ndarray:
        """Whether each query's rows are looked for in each part."""
        order = model.ranked(q.astype(np.float64))
        enough = (np.cumsum(sizes[order], axis=1) <= k).sum(1) + 1
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, np.arange(parts) < np.maximum(probes, enough)[:, None], 1)
        return out

    def route(q: np.ndarray, floors: np.ndarray):
        visits = probed(q)
        for part in np.flatnonzero(visits.any(axis=0)):
            go = np.flatnonzero(visits[:, part])
            for block in number[cells == part]:
                yield block, go

    if len(known[0]):
        p = model.probabilities(known[1].astype(np.float64))
        home = p.argmax(1)
        # rows between two parts may have been placed in either
        sure = np.ones(len(p), bool) if parts == 1 else np.diff(np.sort(p, 1)[:, -2:], axis=1)[:, 0] > 1e-9

    def meets(q: np.ndarray) -> np.ndarray:
        return probed(q)[:, home] & sure

    return V.search(blocks, k, route, product, dtype, known, meets)
