"""A1-A3: readers.  Column selection happens at the scan so Catalyst prunes
the parquet ``ReadSchema``; filters written after the read are pushed down."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Canonical article columns and the raw names they come from by default.
ARTICLE_COLUMNS = {"url": "url", "date": "date", "language": "language", "title": "title", "text": "text"}


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None,
          spread: bool = False) -> DataFrame:
    """One parquet table of a scale-factor folder, optionally projected.

    ``spread`` is for tables feeding CPU-heavy per-row text work: when the
    scan yields fewer tasks than the cluster has cores (one large row group,
    a handful of files) the rows are dealt round-robin over all cores.  On
    large inputs the scan is already wide and nothing is added.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread_rows(df) if spread else df


def spread_rows(df: DataFrame) -> DataFrame:
    """Round-robin repartition to the default parallelism if the plan is
    narrower than that (planning only; no job runs to decide)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def with_file_order(df: DataFrame) -> DataFrame:
    """Attach ``_file_order`` = (file path, row index in file).

    It reproduces "first row in file order" without a global sort: a struct
    ordered by file then row, usable by ``min_by``.
    """
    return df.withColumn(
        "_file_order",
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")),
    )


def read_articles(
    spark: SparkSession,
    path: str,
    colmap: Mapping[str, str] | None = None,
    keep_file_order: bool = True,
) -> DataFrame:
    """A1: read a raw article corpus and rename to canonical columns.

    ``colmap`` maps canonical name -> source column.  The date column is
    parsed to a UTC timestamp (unparseable -> null, B1).
    """
    from ..functions.dates import parse_date

    colmap = {**ARTICLE_COLUMNS, **(colmap or {})}
    raw = spark.read.parquet(path)
    if keep_file_order:
        raw = with_file_order(raw)
    cols = [F.col(src).alias(dst) for dst, src in colmap.items() if dst != "date"]
    cols.append(parse_date(F.col(colmap["date"]), raw.schema[colmap["date"]].dataType.typeName()).alias("date"))
    if keep_file_order:
        cols.append(F.col("_file_order"))
    return raw.select(*cols)


LABEL_SCHEMA = StructType(
    [
        StructField("topic", IntegerType()),
        StructField("topic_name", StringType()),
        StructField("industry_label", StringType()),
        StructField("keep", IntegerType()),
    ]
)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A2: the curated topic-label CSV (explicit schema, doubled quotes)."""
    return spark.read.csv(path, header=True, schema=LABEL_SCHEMA, escape='"')


def read_training(spark: SparkSession, path: str, id_col: str, split_col: str | None = None) -> DataFrame:
    """A3: labelled text with a train/validation/test split.

    An existing split column is kept; otherwise the split is a function of
    md5(id) (see ``md5_split``), so it does not depend on partitioning or
    file order and any SQL engine can reproduce it.
    """
    df = spark.read.parquet(path)
    if split_col and split_col in df.columns:
        return df.withColumnRenamed(split_col, "split")
    return df.withColumn("split", md5_split(id_col))


def md5_split(id_col) -> F.Column:
    """train / validation / test = 13/16, 1/16, 2/16 by the first hex digit of md5(id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.substring(F.md5(c.cast("string")), 1, 1)
    return F.when(h < "d", "train").when(h == "d", "validation").otherwise("test")
