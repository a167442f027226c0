"""Near-duplicates: SuperMinHash bands, verification on full shingle sets,
union-find groups.

1. One pass over the texts gives each document the size of its shingle set, a
   128-bit name of the set and its band keys.  Documents with the same set are
   one class from here on, so groups of copies cost one row.
2. Classes that share a band key are a bucket.  Instead of all its pairs, a
   bucket offers each member paired with one *leader*: the member that shares
   the most buckets, which is the text the others were copied from.
3. Pairs are confirmed by the sizes of the intersection and union of the full
   sets, recomputed from the texts; confirmed links make components.
4. In a bucket that still holds members of several components, those outside
   of the largest one are compared with all the others, so that no link between
   candidates is lost.  One product of 0/1 matrices gives all the shared counts
   of a bucket; a large bucket is dealt out in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import consecutive_ids
from ..sources.writers import materialize
from . import superminhash as S
from .arrow import chunks
from .components import components

SIMILAR = 75      # per cent of the union that must be shared
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1 << 20   # of a block in step 4


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        sets = S.shingle_sets(batch.column("text").to_pylist())
        keys = S.band_keys(S.signatures(sets)).ravel()
        offsets = np.arange(len(sets) + 1, dtype=np.int32) * S.BANDS
        own = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in own), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([S.set_key(s) for s in sets], pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))], names=[*own, "n", "key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        sets = S.shingle_sets(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"),
                                          pa.array([s.tobytes() for s in sets], pa.binary())],
                                         names=[*(c for c in batch.schema.names if c != "text"), "set"])


def _keyed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        sets = S.shingle_sets(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([S.set_key(s) for s in sets], pa.binary()),
                                          pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "set"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets share SIMILAR per cent of their union."""
    if 100 * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)) or not len(a):
        return False
    shared = len(a) + len(b) - len(np.union1d(a, b)) if len(a) + len(b) < 64 else _shared(a, b)
    return 100 * shared >= SIMILAR * (len(a) + len(b) - shared)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # two sorted runs: a merge
    return int((both[1:] == both[:-1]).sum())


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sa, sb = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
        ok = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(sa, sb, strict=True)], pa.bool_())
        yield batch.select(["a", "b"]).filter(ok)


def _sizes_fit(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILAR


def _leader_pairs(members: DataFrame) -> DataFrame:
    """``a, b``: members of ``key`` with its leader, the one of most weight;
    sizes that rule a link out go."""
    leaders = members.groupBy("key").agg(
        F.max(F.struct("w", (-F.col("id")).alias("i"), F.col("n").alias("n"))).alias("l"))
    return members.join(leaders, "key").filter(
        (F.col("id") != -F.col("l.i")) & _sizes_fit(F.col("n"), F.col("l.n"))
    ).select(F.col("id").alias("a"), (-F.col("l.i")).alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    return materialize(pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(
        _confirm, "a long, b long"), "links")


def _mixed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``key, id, n, comp`` of the keys that hold more than one component.  Of
    two members one is the leader: that pair has been confirmed or refused."""
    members = members.join(comps, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("comp"))
    keys = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m")
                                     ).filter("lo < hi and m > 2").select("key")
    return members.join(keys, "key", "left_semi")


def _bucket_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between members of different components, in one block or between
    two."""
    pdf = pdf.drop_duplicates("id", ignore_index=True)
    n, ids, block = pdf["n"].to_numpy(), pdf["id"].to_numpy(), pdf["block"].to_numpy()
    comp = np.unique(pdf["comp"].to_numpy(), return_inverse=True)[1]
    if (block == block[0]).all():
        rows, cols = np.flatnonzero(comp != np.bincount(comp).argmax()), np.arange(len(ids))
    else:
        rows, cols = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    # shingles that only one member holds are shared with none
    member = np.repeat(np.arange(len(ids)), [len(x) // 8 for x in pdf["set"]])
    _, place, seen = np.unique(np.frombuffer(b"".join(pdf["set"]), np.uint64), return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1
    member, place = member[seen[place] > 1], number[place[seen[place] > 1]]
    order = np.argsort(place, kind="stable")
    member, place = member[order], place[order]
    shared = np.zeros((len(rows), len(cols)), np.float32)
    width = max(64, (1 << 22) // len(ids))
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [start, start + width])
        held = np.zeros((len(ids), width), np.float32)
        held[member[a:b], place[a:b] - start] = 1
        shared += held[rows] @ held[cols].T
    alike = (100 * shared >= SIMILAR * (n[rows][:, None] + n[cols] - shared)) & (comp[rows][:, None] != comp[cols])
    r, c = np.nonzero(alike)
    return pd.DataFrame({"a": ids[rows[r]], "b": ids[cols[c]]}, dtype="int64")


def _rest_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Step 4: all links between members of one key and several components."""
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(members.groupBy("key").agg(blocks.alias("blocks")), "key").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "n", "comp")
    return materialize(dealt.join(sets, "id").groupBy("key", "lo", "hi").applyInPandas(
        _bucket_links, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``
    (and ``row``, the column ``row_col``, if one is named).

    Documents are linked if their sets of 5-word shingles share 75 % of the
    union; ``component_id`` is the least doc_id that links lead to, ``kept``
    whether that is the row's own.  Null and empty texts, and texts without
    words, have an empty set, are linked with nothing and are kept.  Rows that
    repeat a doc_id are documents of their own: each has the component of its own
    text, and no link of any of them is lost.  Rows without an id take no part:
    null component, kept.  An empty table gives an empty result.  Other columns
    of ``docs`` are ignored, whatever their names.
    """
    carried = [] if row_col is None else [F.col(f"`{row_col}`").alias("row")]
    docs = docs.select(*carried, F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    row = f"row {docs.schema['row'].dataType.simpleString()}, " if carried else ""
    rows = materialize(docs.mapInArrow(_fingerprints, row + "doc_id long, n long, key binary, bands array<long>"), "minhash_rows")
    known = rows.filter("doc_id is not null and n > 0")
    classes = materialize(known.groupBy("key").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "minhash_classes")
    # Texts of one repeated id are classes with one least id: they get numbers
    # below all ids, and the least ids are put back at the end.
    twice = materialize(classes.groupBy("id").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("id"), "minhash_twice")
    clash = not twice.isEmpty()
    if clash:
        base = classes.agg(F.min("id")).first()[0] - 1
        fresh = consecutive_ids(classes.join(twice, "id", "left_semi").select("id", "key"), ["id", "key"], "k")
        fresh = fresh.select("key", (F.lit(base) - F.col("k")).alias("fresh"))
        classes = materialize(classes.withColumnRenamed("id", "label").join(fresh, "key", "left").select(
            "key", F.coalesce("fresh", "label").alias("id"), "n", "bands", "label"), "minhash_classes")

    banded = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
    members = materialize(banded.join(shared, "key"), "minhash_members")
    weights = members.groupBy("id").agg(F.sum("cnt").alias("w"))
    members = materialize(members.drop("cnt").join(weights, "id"), "minhash_weighted")

    texts = docs.drop("row")
    wanted = weights.select(F.col("id").alias("doc_id"))
    sets = texts.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, set binary").select(F.col("doc_id").alias("id"), "set")
    if clash:
        several = texts.join(twice.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").mapInArrow(_keyed_sets, "key binary, set binary")
        numbered = classes.filter("id <> label").select("key", "id").join(weights.select("id"), "id", "left_semi")
        sets = sets.unionByName(several.groupBy("key").agg(F.first("set").alias("set")).join(numbered, "key").select("id", "set"))
    sets = materialize(sets, "minhash_sets")

    links = _confirmed(_leader_pairs(members), sets)
    comps = components(links)
    mixed = materialize(_mixed(members, comps), "minhash_mixed")
    if not mixed.isEmpty():
        comps = components(links.unionByName(_rest_links(mixed, sets)))

    named = classes.join(comps, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    if clash:
        least = named.groupBy("component_id").agg(F.min("label").alias("least"))
        named = named.join(least, "component_id").withColumn("component_id", F.col("least"))
    named = named.select("key", "component_id")
    out = rows.select(*rows.columns[:-3], F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("key")).alias("key"))
    out = out.join(named, "key", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select(*rows.columns[:-3], "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
