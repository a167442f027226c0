"""H (aggregations, profiling), I (windows) and J (sort / reshape) operators.

Every grouped count is a partial + final hash aggregate; group totals use a
window over the already-aggregated (small) table, never over raw rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_end


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """H1: rows per key combination; rows with a null key are dropped (pandas)."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_month(df: DataFrame, date_col: str, key: str, name: str = "count") -> DataFrame:
    """H2: rows per (month end, key)."""
    return (
        df.dropna(subset=[date_col, key])
        .groupBy(month_end(F.col(date_col)).alias(date_col), F.col(key))
        .agg(F.count(F.lit(1)).alias(name))
    )


def add_share(df: DataFrame, part: Sequence[str] | str, value: str = "count",
              total: str = "total", share: str = "pct") -> DataFrame:
    """Group total beside each row and the row's share of it."""
    part = [part] if isinstance(part, str) else list(part)
    w = Window.partitionBy(*part)
    return df.withColumn(total, F.sum(value).over(w)).withColumn(share, F.col(value) / F.col(total))


def top_k_per_group(df: DataFrame, group: Sequence[str] | str, k: int, order: Sequence[Column | str],
                    rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per group in ``order``.

    ``row_number() <= k`` is planned as a ``WindowGroupLimit`` (partial before
    the shuffle, final after), so each map task ships at most ``k`` rows per group.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def top_k(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """Global top-k (``TakeOrderedAndProject``: per-task top-k, then merge)."""
    return df.orderBy(*_cols(order)).limit(k)


def value_counts(df: DataFrame, col: str, k: int | None = None, name: str = "count") -> DataFrame:
    """H7: distinct values with their counts, most frequent first."""
    out = count_by(df, col, name=name)
    order = [F.col(name).desc(), F.col(col).asc()]
    return top_k(out, k, order) if k else out


def time_report(df: DataFrame, col: str = "date") -> DataFrame:
    """H3: percent parsed, min, max, missing (strings in the published form)."""
    fmt = "yyyy-MM-dd HH:mm:ssxxx"
    return df.agg(
        (F.count(col) * 100.0 / F.count(F.lit(1))).alias("parse_success_pct"),
        F.date_format(F.min(col), fmt).alias("min_date_utc"),
        F.date_format(F.max(col), fmt).alias("max_date_utc"),
        F.count_if(F.col(col).isNull()).alias("n_missing_date"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column null count and null share, one row per column.

    One pass: a single aggregate of ``count_if(isnull)`` per column, then
    ``stack`` turns the one wide row into rows.
    """
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)],
    )
    dtypes = dict(df.dtypes)
    pairs = ", ".join(f"'{c}', '{dtypes[c]}', `_null_{i}`" for i, c in enumerate(columns))
    long = wide.selectExpr("_n", f"stack({len(columns)}, {pairs}) as (column_name, dtype, null_count)")
    return long.select(
        "column_name", "dtype", "null_count",
        (F.col("null_count") / F.col("_n")).alias("null_share"),
    )


def percentiles(df: DataFrame, col: Column | str, ps: Sequence[float], name: str = "value") -> DataFrame:
    """H5: exact percentiles (linear interpolation), one row per probability.

    Spark's exact ``percentile`` keeps a value -> count map per task; meant for
    integer measures such as lengths, whose distinct count is bounded by the
    longest text.  For unbounded continuous scores use ``relevance.quantile``.
    """
    c = F.col(col) if isinstance(col, str) else col
    arr = df.agg(F.percentile(c, F.array(*[F.lit(float(p)) for p in ps])).alias("_q"))
    return arr.select(
        F.posexplode(F.arrays_zip(F.array(*[F.lit(float(p)) for p in ps]).alias("p"), F.col("_q").alias("v")))
    ).select(F.col("col.p").alias("p"), F.col("col.v").alias(name))


def describe(df: DataFrame, col: Column | str, ps: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """H6: count, mean, std, min, percentiles, max in one aggregate."""
    c = F.col(col) if isinstance(col, str) else col
    q = F.percentile(c, F.array(*[F.lit(float(p)) for p in ps]))
    aggs = [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev(c).alias("std"), F.min(c).alias("min")]
    wide = df.agg(*aggs, q.alias("_q"), F.max(c).alias("max"))
    names = [f"p{int(round(p * 100))}" for p in ps]
    return wide.select("count", "mean", "std", "min", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], "max")


def sum_by(df: DataFrame, key: str, value: str = "count", name: str = "total") -> DataFrame:
    """H9: total per label over all groups."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence[str], value: str = "count") -> DataFrame:
    """``row`` x ``col`` table with an explicit column list, missing -> 0.

    The explicit value list avoids the extra distinct job and bounds the width.
    """
    return df.groupBy(row).pivot(col, list(values)).agg(F.sum(value)).fillna(0)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """H13."""
    return df.select(col).distinct()


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Reproducible sample of exactly ``n`` rows (hash order, top-n)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)


def consecutive_ids(df: DataFrame, order: Sequence[Column | str], name: str = "id") -> DataFrame:
    """0, 1, 2, ... in ``order`` without funnelling rows through one task.

    The frame is range-sorted and written once (so partitioning is fixed),
    each row gets its position inside its partition, and a per-partition
    offset - one number per partition - turns that into a global rank.
    """
    from ..sources.writers import materialize

    shift = 33  # monotonically_increasing_id: partition index in the upper bits
    ordered = materialize(df.orderBy(*_cols(order)).withColumn("_mid", F.monotonically_increasing_id()),
                          "ordered")
    part = F.shiftright(F.col("_mid"), shift)
    counts = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    offsets, total = {}, 0
    for p, n in counts:
        offsets[p] = total
        total += n
    offset_map = F.create_map(*[x for p, o in offsets.items() for x in (F.lit(p), F.lit(o))]) if offsets else None
    local = F.col("_mid") - F.shiftleft(part, shift)
    rank = (offset_map[part] + local) if offset_map is not None else local
    return ordered.withColumn(name, rank).drop("_mid")
