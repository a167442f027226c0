"""Longest-processing-time sharding: rows with the same text stay together.

LPT scheduling is sequential, so it runs over a bounded number of *items*:

* a group of equal texts above ``1 / ITEMS`` of all bytes is an item of its
  own - there are fewer than ``ITEMS`` of those, whatever the input;
* all smaller groups are bundled by the first two bytes of the text's md5:
  65,536 bundles, whatever the input.

Items, sorted by size, go to the least-loaded shard through a heap.  At most
131,072 (item, bytes) pairs reach the driver; documents, texts and group keys
never do.  With 40 shards a bundle is at most about 1/1,600 of a shard, and
the smallest bundles go last, so shard sizes end up near equal unless one
group alone exceeds a shard.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import materialize

ITEMS = 1 << 16       # bundles of small groups; bound on the number of large groups
CELL_ROWS = 2048      # rows numbered together when slots are given out
ROW_OVERHEAD = 16     # bytes a row costs besides its text


def assign_lpt(items: list[tuple[bytes, int]], n_shards: int) -> list[int]:
    """Shard of each (item, bytes): largest first, to the least-loaded shard
    (ties: lower item, lower shard)."""
    heap = [(0, s) for s in range(n_shards)]
    out = [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-items[i][1], items[i][0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + items[i][1], shard))
        out[i] = shard
    return out


def lpt_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard,
    slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 16.  Null texts have size 16, a
    null checksum, and count as one group; empty texts are a group as any
    other.  ``slot`` numbers the rows of a shard from 0 without gaps, in no
    particular order.  An empty table gives an empty result.  Other columns of
    ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.coalesce(text.cast("binary"), F.encode(F.lit("\x00null text"), "UTF-8")))).alias("key"),
    ), "lpt_rows")
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    n_rows, limit = total["n"], (total["bytes"] or 0) // ITEMS

    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    items = groups.groupBy(
        F.when(F.col("bytes") > limit, F.col("key")).otherwise(F.substring("key", 1, 2)).alias("item")
    ).agg(F.sum("bytes").alias("bytes"))
    found = [(bytes(r["item"]), r["bytes"]) for r in items.collect()]  # fewer than 2 * ITEMS
    shards = assign_lpt(found, n_shards)

    def table(width: int) -> DataFrame:
        """Shards of the items with keys of this width: at most ITEMS rows."""
        own = [(k, s) for (k, _), s in zip(found, shards, strict=True) if len(k) == width]
        return spark.createDataFrame(pa.table({
            "item": pa.array([k for k, _ in own], pa.binary()), f"shard{width}": pa.array([s for _, s in own], pa.int32())}))

    placed = (
        rows.withColumn("bundle", F.substring("key", 1, 2))
        .join(F.broadcast(table(16).withColumnRenamed("item", "key")), "key", "left")
        .join(F.broadcast(table(2).withColumnRenamed("item", "bundle")), "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("shard16", "shard2").alias("shard"))
    )
    # Slots: rows fall in cells (shard, hash) of about CELL_ROWS rows; a cell
    # starts where the cells before it in its shard end.
    per_shard = max(1, -(-n_rows // (n_shards * CELL_ROWS)))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(per_shard)))
    order = Window.partitionBy("shard").orderBy("cell")
    starts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "cell", (F.sum("n").over(order) - F.col("n")).alias("start"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("start") + F.col("_at")).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )
