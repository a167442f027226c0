"""Incremental (Structured Streaming) form of the tagging report.

The batch stages of the corpus workflow re-run over whole files; here the
same column functions run over a file stream: new parquet files of raw
articles are cleaned, tagged and folded into running (industry, tag) counts.
The aggregation state lives in the query's checkpoint (shared folder), so a
restarted driver or lost executor resumes from the last committed batch.
Each micro-batch rewrites the complete result table (``foreachBatch``), which
is small - one row per (industry, tag).
"""

from __future__ import annotations

import os
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import with_clean
from ..operators.filters import filter_language, filter_length
from ..operators.tagging import tag_articles, tag_counts


def tagged_counts(raw: DataFrame, dictionary: Mapping[str, Sequence[str]], tag_col: str = "tag",
                  group_src: str = "source", lang_col: str = "lang") -> DataFrame:
    """Raw documents -> (industry_label, tag, count); works on batch or stream."""
    arts = raw.select(
        F.col(group_src).alias("industry_label"), F.col(lang_col).alias("language"), F.col("text"))
    kept = filter_length(filter_language(arts))
    clean = with_clean(kept, "text", "text_clean").select("industry_label", "text_clean")
    return tag_counts(tag_articles(clean, "text_clean", {tag_col: dictionary}), "industry_label", tag_col)


def _names_folders(spark: SparkSession, pattern: str) -> bool:
    """Whether the path pattern names folders, in any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return any(f.isDirectory() for f in found)


def run_tag_counts_stream(spark: SparkSession, source_dir: str, file_glob: str,
                          dictionary: Mapping[str, Sequence[str]], out_dir: str, checkpoint: str,
                          tag_col: str = "tag") -> DataFrame:
    """Run the stream over every file available now, then return the result table.

    What ``file_glob`` names in ``source_dir`` may be files or folders of part files.
    Without a row the table is empty.
    """
    source = os.path.join(source_dir, file_glob)
    stream = spark.readStream.schema(spark.read.parquet(source).schema)
    if _names_folders(spark, source):
        raw = stream.parquet(source)
    else:  # a file source takes folders only
        raw = stream.option("pathGlobFilter", file_glob).parquet(source_dir)
    counts = tagged_counts(raw, dictionary, tag_col)
    spark.createDataFrame([], counts.schema).write.mode("ignore").parquet(out_dir)  # stays if no batch ever comes

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)

    q = (
        counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
        .foreachBatch(publish).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(out_dir)
