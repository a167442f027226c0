"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are dealt in equal blocks.  Sources get whole blocks by highest
quotients (ideal / 1, / 3, / 5, ...), then each source's blocks are
apportioned the same way over its shards, giving an integer quota per (source,
shard).  Inside a shard the source's documents are laid end to end in a seeded
order and the first ``quota`` blocks of that layout are taken, going round a
second time where the quota exceeds the layout (a target stops at twice its
source's size, so nothing is taken more than twice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import materialize

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 16              # words of a block
SHARD_WORDS = 1 << 19         # words of a shard: the shard count follows the input
WEIGHTS = (5, 2, 1)           # of the sources in code-point order, repeating
SHARE = 1.5                   # size of the mix as a share of all words
MAX_REPEAT = 2                # a target stops at so many times its source's size
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of white-space separated words; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sainte_lague(df: DataFrame, by: list[str], ideal: str, seats: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: whole seats per row, ``seats`` in all within each ``by``
    group, by highest quotients of ``ideal`` (its sum is about ``seats``).

    Rounding ``ideal`` is at most a few seats off: with n rows in a group the
    divisor moves by at most n / seats, hence ``n * ideal / seats + 2`` seats
    around the rounded number are the only open ones.  Those are ranked by
    quotient (ties: ``order``), so the work is linear in the rows, not in the
    seats.
    """
    whole = Window.partitionBy(*by)
    x = F.col(ideal)
    near = F.floor(x + 0.5)
    slack = F.ceil(F.count(F.lit(1)).over(whole) * x / F.greatest(F.sum(ideal).over(whole), F.lit(1e-300))) + 2
    df = df.withColumn("_low", F.greatest(near - slack, F.lit(0))).withColumn("_high", near + slack)
    df = df.withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    open_seats = df.select(*by, *order, ideal, "_left", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j"))
    ranked = open_seats.withColumn("_pos", F.row_number().over(
        Window.partitionBy(*by).orderBy((x / (2 * F.col("_j") - 1)).desc(), *order, "_j")))
    won = ranked.groupBy(*by, *order).agg(F.count_if(F.col("_pos") <= F.col("_left")).alias("_won"))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"w.{c}")) for c in [*by, *order]]
    joined = df.alias("l").join(won.alias("w"), on)
    return joined.select("l.*", "w._won").withColumn(out, (F.col("_low") + F.col("_won")).cast("long")).drop(
        "_low", "_high", "_left", "_won")


def source_targets(sources: DataFrame) -> DataFrame:
    """``source, source_size`` -> plus ``target``: words the mix wants.

    Weights follow the sources in code-point order, null last.  Water filling:
    in ascending order of limit / weight a source is held at its limit while
    its weighted share of what is left reaches it; the others share the rest.
    The table has one row per source.
    """
    one = F.lit(0).alias("_one")
    rank = F.row_number().over(Window.partitionBy("_one").orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    s = sources.select("source", "source_size", one).withColumn("_rank", rank)
    s = s.withColumn("_w", F.element_at(weights, ((F.col("_rank") - 1) % len(WEIGHTS) + 1).cast("int")))
    s = s.withColumn("_limit", (MAX_REPEAT * F.col("source_size")).cast("double"))
    all_ = Window.partitionBy("_one")
    before = all_.orderBy(F.col("_limit") / F.col("_w"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    total = SHARE * F.sum("source_size").over(all_)
    left = total - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(all_) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    s = s.withColumn("_total", total).withColumn("_held", F.col("_limit") <= F.col("_w") * left / weight_left)
    free = lambda c: F.sum(F.when(~F.col("_held"), F.col(c)).otherwise(0.0)).over(all_)
    held = F.sum(F.when(F.col("_held"), F.col("_limit")).otherwise(0.0)).over(all_)
    share = F.col("_w") * (F.col("_total") - held) / free("_w")
    return s.withColumn("target", F.when(F.col("_held"), F.col("_limit")).otherwise(share)).select(
        "source", "source_size", "target", "_rank", "_total", "_one")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        row_col: str | None = None, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source, source_size,
    target, taken``, and ``row_col`` as ``row`` if given.

    ``taken`` counts the words of the document that the mix holds, repeats
    included (0 to twice ``size``).  Null and empty texts have size 0 and
    nothing taken; a null source is a source of its own, last in order; rows
    that repeat a doc_id are rows of their own; an empty table gives an empty
    result.  The order depends on the seed and doc_id only, so reruns agree.
    Other columns of ``docs`` are ignored, whatever their names.
    """
    doc = F.col(f"`{id_col}`")
    carried = [F.col(f"`{row_col}`").alias("row")] if row_col else []
    rows = materialize(docs.select(
        *carried, doc.alias("doc_id"), word_count(F.col(f"`{text_col}`")).alias("size"), F.col(f"`{source_col}`").alias("source"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc.cast("string"), F.lit("null")))).alias("_h"),
    ), "mix_rows")
    words = rows.agg(F.sum("size")).first()[0] or 0
    n_shards = max(1, -(-words // shard_words))
    rows = rows.withColumn("_shard", F.pmod(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), F.lit(n_shards)))

    cells = materialize(rows.groupBy("source", "_shard").agg(F.sum("size").alias("_cell")), "mix_cells")
    sources = source_targets(cells.groupBy("source").agg(F.sum("_cell").alias("source_size")))
    sources = sources.withColumn("_x", F.col("target") / block_words).withColumn(
        "_seats", F.floor(F.col("_total") / block_words + 0.5))
    sources = sainte_lague(sources, ["_one"], "_x", "_seats", ["_rank"], "_blocks")

    own = cells.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        "c.source", "_shard", "_cell", "source_size", "target", "_rank", "_blocks",
        F.when(F.col("source_size") > 0, F.col("_blocks").cast("double") * F.col("_cell") / F.col("source_size"))
        .otherwise(0.0).alias("_x"))
    quotas = sainte_lague(own, ["_rank"], "_x", "_blocks", ["_shard"], "_quota")
    quotas = quotas.select("source", "_shard", "_cell", "source_size", "target", F.least(
        F.col("_quota") * block_words, MAX_REPEAT * F.col("_cell")).alias("_words"))

    start = F.sum("size").over(
        Window.partitionBy("source", "_shard").orderBy("_h", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    laid = rows.withColumn("_start", start)
    on = F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r._shard") == F.col("q._shard"))
    reach = lambda to: F.greatest(F.least(to - F.col("_start"), F.col("size")), F.lit(0))
    return laid.alias("r").join(quotas.alias("q"), on).select(
        *(["row"] if row_col else []), "doc_id", "size", "r.source", "source_size", "target",
        (reach(F.col("_words")) + reach(F.col("_words") - F.col("_cell"))).cast("long").alias("taken"))
