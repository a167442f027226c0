"""A4-A7 sinks and the K8 dashboard export.

Stage tables are written as parquet (optionally partitioned); reports as CSV
with doubled quotes (pandas style, X27) or JSON.  Report frames are small
aggregates, so they are coalesced to one file; stage tables never are.
"""

from __future__ import annotations

import os
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "quarry-out", f"{name}-{uuid.uuid4().hex[:12]}")


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """A4: overwrite a stage table as parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_report_csv(df: DataFrame, path: str, single: bool = True) -> str:
    """A5: report as CSV with a header; quotes doubled, outer spaces kept.  ``single``:
    one file, for reports whose size does not follow the data; else one per task."""
    (df.coalesce(1) if single else df).write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def write_report_json(df: DataFrame, path: str) -> str:
    """Report object(s) as JSON (one object per line)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def epoch_millis(df: DataFrame) -> DataFrame:
    """Dates and timestamps as epoch milliseconds (pandas ``to_json`` form, X26)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = F.unix_millis(c)
        elif isinstance(f.dataType, DateType):
            c = F.unix_millis(c.cast("timestamp"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_jsonl(df: DataFrame, path: str) -> str:
    """JSON Lines, non-ASCII kept as is, dates in epoch milliseconds."""
    epoch_millis(df).coalesce(1).write.mode("overwrite").option("encoding", "UTF-8").json(path)
    return path


def export_dashboard(series: DataFrame, topics: DataFrame, impact: DataFrame, technology: DataFrame,
                     folder: str) -> dict[str, str]:
    """K8: the four dashboard tables as JSON files in ``folder``."""
    out = {}
    for name, df in (("sentiment_over_time", series), ("topics", topics),
                     ("industry_impact_counts", impact), ("industry_technology_counts", technology)):
        out[name] = write_report_json(df, os.path.join(folder, name))
    return out


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` as parquet under the shared checkpoint folder
    and return the re-read table.

    One job (a reliable ``checkpoint()`` of an unpersisted frame computes it
    twice: once to count, once to save), columnar on re-read, and the files
    survive executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
