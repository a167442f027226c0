"""Blocks of vectors: the physical side of both vector searches.

Vectors are sorted by (cell, key, vec_id) and packed into blocks of at most
BLOCK rows of one cell, one table row each; a cell of any size, also one that
holds a third of all rows, is simply many blocks.  Queries travel to the blocks
that their routing names, in bundles; each block returns its best candidates
per query, and a window keeps the best of all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import materialize

BLOCK = 4096             # vectors of a block
PART_ROWS = 2 * BLOCK    # vectors of a task that packs
BUNDLE_BYTES = 16 << 20  # query bytes a routing task holds before it sends them on

BLOCK_SCHEMA = ("block long, cell int, low double, high double, ids binary, vecs binary, "
                "query_ids binary, query_vecs binary, floors binary, ties binary")


def usable(vec: Column, zero_ok: bool) -> Column:
    """Not null, not empty, all components finite; not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.size(vec) > 0 if zero_ok else F.exists(vec, lambda x: x != 0)
    return F.coalesce(vec.isNotNull() & finite & some, F.lit(False))


def element_type(vectors: DataFrame, column: str) -> type:
    """numpy type that holds the column's components as they are."""
    return np.float32 if vectors.schema[column].dataType.elementType.typeName() == "float" else np.float64


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as doubles; shorter ones are padded with zeros."""
    lists = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == dim).all():
        return lists.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = lists
    return out


def masked(scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores per distinct id (the best of rows that repeat one) without each
    query's own, the ids, and a row for each.  ``ids`` ascend."""
    start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    scores = np.maximum.reduceat(scores, start, axis=1) if len(start) < len(ids) else np.array(scores, np.float64)
    ids = ids[start]
    at = np.searchsorted(ids, own)
    hit = np.flatnonzero((at < len(ids)) & (ids[np.minimum(at, max(0, len(ids) - 1))] == own)) if len(ids) else []
    scores[hit, at[hit]] = -np.inf
    return scores, ids, start


def kth(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(score, id) of each query's k-th best column: what others have to reach;
    (-inf, the largest id) if there are fewer than k."""
    scores, ids, _ = masked(scores, ids, own)
    floors, ties = np.full(len(scores), -np.inf), np.full(len(scores), np.iinfo(np.int64).max)
    if scores.shape[1] >= k:
        floors = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        for q in np.flatnonzero(floors > -np.inf):
            level = np.flatnonzero(scores[q] == floors[q])
            ties[q] = ids[level[k - 1 - int((scores[q] > floors[q]).sum())]]
    return floors, ties


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray, ties: np.ndarray):
    """(query row, column) of each query's k best columns, and the score.

    A column counts if it beats the query's floor, or equals it with an id not
    above the tie's; ties go to the smaller id.
    """
    scores, distinct, start = masked(scores, ids, own)
    if scores.shape[1] > k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    else:
        cut = np.full(len(scores), -np.inf)
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q in range(len(scores)):
        s = scores[q]
        c = np.flatnonzero(((s > floors[q]) | ((s == floors[q]) & (distinct <= ties[q]))) & (s >= cut[q]) & (s > -np.inf))
        if len(c) > k:
            c = c[np.argsort(-s[c], kind="stable")[:k]]
        rows.append(np.full(len(c), q))
        cols.append(c)
    r, c = np.concatenate(rows), np.concatenate(cols)
    return r, start[c], scores[r, c]


def pack(assigned: DataFrame, n_rows: int, k: int, every: int, product: Callable, dtype: type) -> DataFrame:
    """``vec_id, cell, key, vec binary`` -> the written table of blocks.

    Each block also carries the queries among its rows (ids that ``every``
    divides) and, for each, score and id of its k-th best inside the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            nonlocal seq
            order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
            ids = rows["vec_id"].to_numpy()[order]
            keys = rows["key"].to_numpy()
            vecs = [rows["vec"][i].as_py() for i in order.tolist()]
            q = np.flatnonzero(ids % every == 0)
            floors, ties = np.full(len(q), -np.inf), np.zeros(len(q), np.int64)
            if len(q):
                x = np.frombuffer(b"".join(vecs), dtype)
                x = x.reshape(len(ids), -1)
                for a in range(0, len(q), 256):
                    few = q[a:a + 256]
                    floors[a:a + 256], ties[a:a + 256] = kth(product(x[few], x), ids, ids[few], k)
            seq += 1
            row = [part << 32 | seq, int(rows["cell"][0].as_py()), float(keys.min()), float(keys.max()), ids.tobytes(), b"".join(vecs),
                   ids[q].tobytes(), b"".join(vecs[i] for i in q.tolist()), floors.tobytes(), ties.tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
                                              names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if held and held[0].column("cell")[0] != batch.column("cell")[a]:
                    yield flush(pa.Table.from_batches(held))
                    held = []
                while a < b:
                    take = min(b - a, BLOCK - sum(h.num_rows for h in held))
                    held.append(batch.slice(a, take))
                    a += take
                    if sum(h.num_rows for h in held) >= BLOCK:
                        yield flush(pa.Table.from_batches(held))
                        held = []
        if held:
            yield flush(pa.Table.from_batches(held))

    parts = max(1, -(-n_rows // PART_ROWS))
    ranged = assigned.repartitionByRange(parts, "cell", "key", "vec_id").sortWithinPartitions("cell", "key", "vec_id")
    return materialize(ranged.mapInArrow(run, BLOCK_SCHEMA), "vector_blocks")


def search(blocks: DataFrame, k: int, route: Callable, product: Callable, dtype: type,
           known: tuple[np.ndarray, np.ndarray], meets: Callable | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query.

    ``known`` are a few (ids, vectors) of the table.  A query's k-th best among
    them, or in its own block if that is better, is what a candidate has to
    reach to be sent on at all.  ``route(queries, floors)`` yields (block, rows
    of the queries that go there); a query bundle meets its block by an
    equi-join on the block's number.

    A route that leaves blocks out by guess gives ``meets(queries)``: whether each
    query is sure to meet each row of ``known`` (query x row).  Only such rows set
    floors, and each query also meets its own block, so that no floor is
    above what the query finds.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles: dict[int, list] = {}
        size = 0

        def out() -> pa.RecordBatch:
            rows = [(b, *(b"".join(x) for x in zip(*parts, strict=True))) for b, parts in bundles.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64(), *[pa.binary()] * 4])],
                names=["block", "query_ids", "query_vecs", "floors", "ties"])

        for batch in batches:
            for row in batch.to_pylist():
                all_ids = np.frombuffer(row["query_ids"], np.int64)
                for a in range(0, len(all_ids), 256):
                    ids = all_ids[a:a + 256]
                    vecs = np.frombuffer(row["query_vecs"], dtype).reshape(len(all_ids), -1)[a:a + 256]
                    floors, ties = np.frombuffer(row["floors"])[a:a + 256], np.frombuffer(row["ties"], np.int64)[a:a + 256]
                    level, tie = product(vecs, known[1]), known[0]
                    if meets is not None:
                        level = np.where(meets(vecs), level, -np.inf)
                    level, tie = kth(level, tie, ids, k)
                    better = (level > floors) | ((level == floors) & (tie < ties))
                    floors, ties = np.where(better, level, floors), np.where(better, tie, ties)
                    routed = list(route(vecs, floors))
                    if meets is not None:
                        here = [q for block, q in routed if block == row["block"]]
                        away = np.setdiff1d(np.arange(len(ids)), np.concatenate([np.zeros(0, np.int64), *here]))
                        routed += [(row["block"], away)] if len(away) else []
                    for block, q in routed:
                        part = (ids[q].tobytes(), vecs[q].tobytes(), floors[q].tobytes(), ties[q].tobytes())
                        bundles.setdefault(int(block), []).append(part)
                        size += sum(map(len, part))
                if size >= BUNDLE_BYTES:
                    yield out()
                    bundles, size = {}, 0
        if bundles:
            yield out()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                qid, ids = np.frombuffer(raw["query_ids"], np.int64), np.frombuffer(raw["ids"], np.int64)
                floors, ties = np.frombuffer(raw["floors"]), np.frombuffer(raw["ties"], np.int64)
                q = np.frombuffer(raw["query_vecs"], dtype).reshape(len(qid), -1)
                x = np.frombuffer(raw["vecs"], dtype).reshape(len(ids), -1)
                for a in range(0, len(qid), 256):
                    b = a + 256
                    r, c, s = best(product(q[a:b], x), ids, qid[a:b], k, floors[a:b], ties[a:b])
                    yield pa.RecordBatch.from_arrays([pa.array(qid[a:b][r]), pa.array(ids[c]), pa.array(s)],
                                                     names=["query_id", "vec_id", "score"])

    sent = blocks.select("block", "query_ids", "query_vecs", "floors", "ties").mapInArrow(
        send, "block long, query_ids binary, query_vecs binary, floors binary, ties binary")
    met = sent.join(blocks.select("block", "ids", "vecs"), "block")
    found = met.select("query_ids", "query_vecs", "floors", "ties", "ids", "vecs").mapInArrow(
        score, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # rows that repeat an id count once
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def sample(vectors: DataFrame, n: int, dim: int, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of at most ``n`` rows, the first by a hash of their id;
    ids ascend, one row each."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("vec_id", "vec").toArrow()
    ids, first = np.unique(rows["vec_id"].to_numpy(), return_index=True)
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros((0, dim), dtype)
    return ids, np.frombuffer(b"".join(rows["vec"].to_pylist()), dtype).reshape(rows.num_rows, dim)[first]
