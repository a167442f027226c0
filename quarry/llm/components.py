"""Connected components of links between integer ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import materialize


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all nodes but the least ones."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))
    half = len(a)
    for x, y in zip(flat[:half].tolist(), flat[half:].tolist(), strict=True):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x < y:
            parent[y] = x
        elif y < x:
            parent[x] = y
    root = np.array(parent, np.int64)
    for i in range(len(root)):  # parents come before their children
        root[i] = root[root[i]]
    child = np.flatnonzero(root != np.arange(len(root)))
    return nodes[child], nodes[root[child]]


FOREST_LINKS = 1 << 18  # links that one union-find holds at a time


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task -> fewer links with the same components; at most about
    FOREST_LINKS are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out(pair):
        return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["a", "b"])

    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += batch.num_rows
        if size >= FOREST_LINKS:
            held = [union_find(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            size = len(held[0][0])
            if size >= FOREST_LINKS // 2:
                yield out(held.pop())
                size = 0
    if held:
        yield out(union_find(*(np.concatenate(x) for x in zip(*held, strict=True))))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task -> every id with the least id of its component."""
    parts = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches]
    if parts:
        found = union_find(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["id", "component"])


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (long) -> ``id, component``: the least id that can be reached,
    for every id that differs from it.

    Tasks first reduce their own links by union-find.  Then large-star and
    small-star rounds hang every id under the least neighbour, until nothing
    changes or the links that are left fit in one union-find (FOREST_LINKS,
    whatever the input).  Each round is written to the shared folder, so a lost
    executor costs one round.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        .mapInArrow(_forest, "a long, b long"), "forest")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] <= FOREST_LINKS:
            return materialize(edges.coalesce(1).mapInArrow(_whole, "id long, component long"), "components")
        if now == state:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = now
        # large star: every larger neighbour goes to the least neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        # small star: every smaller neighbour, and the id, go to the least one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "star")
