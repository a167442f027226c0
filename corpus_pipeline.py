"""Corpus pipeline: four stages over ``documents``, each on all that its
predecessor kept.

1. language ID: texts without a letter, and texts that no learned language
   explains (bits a character above the bound of its own labelled texts), go;
2. near-dedup: the document with the least id of each group stays (rows that
   repeat an id are documents of their own: a text goes only as a copy);
3. mix: each document appears with as many words as the mix takes of it, as a
   whole row for each full use and a row with its first words for the rest;
4. SentencePiece: piece ids of what is left.

All but the last return the columns of ``documents``, also those that the
caller added, whatever their names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import language_id, minhash_dedup, mixing, pieces
from quarry.llm.queries import PIECE_MODEL, read_file
from quarry.session import prepare
from quarry.sources.writers import materialize

# Bound for languages with too few labelled texts to set their own.  A text in a
# script that was not learned needs about 14.3 bits a character, one in another
# language of a learned script 5 to 9, and one in a learned language 2 to 5.
MAX_BITS = 10.0


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until they are no columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the place of each row in its file, which is the same in
    every reading and tells rows apart that repeat an id.  A table that was not
    read from files is written first."""
    place = F.struct("_metadata.file_path", "_metadata.row_index").alias(name)
    try:
        return docs.select("*", place)
    except AnalysisException:
        return materialize(docs, "pipeline_docs").select("*", place)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language was recognised."""
    prepare(spark)
    labelled = docs.select("doc_id", "text", "lang")
    samples = language_id.language_samples(labelled)
    return language_id.keep_explained(docs, samples, language_id.bounds(labelled, samples, MAX_BITS))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least id, and
    of rows that repeat this id and belong to the group, the first by place."""
    prepare(spark)
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1").isEmpty():
        groups = minhash_dedup.near_duplicates(docs.select("doc_id", "text"))
        (name,) = _fresh(docs, "gone")
        gone = groups.filter(~F.col("kept")).select(F.col("doc_id").alias(name))
        return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
    # ids that repeat: rows are told apart by their place
    (row,) = _fresh(docs, "row")
    rows = _numbered(docs, row)
    groups = minhash_dedup.near_duplicates(rows.select(row, "doc_id", "text"), row_col=row)
    alike = materialize(groups.filter("n_shingles > 0 and doc_id is not null"), "pipeline_groups")
    first = alike.groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    gone = alike.join(first, "row", "left_anti").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often and as far as the mix takes them."""
    prepare(spark)
    row, words, whole = _fresh(docs, "row", "words", "whole")
    rows = _numbered(docs, row)
    taken = mixing.mix(rows.select(row, "doc_id", "text", "source"), row_col=row).filter("taken > 0")
    uses = taken.select(F.col("row").alias(row), F.explode(
        F.when(F.col("taken") > F.col("size"), F.array(F.col("size"), F.col("taken") - F.col("size"))).otherwise(F.array("taken"))
    ).alias(words), F.col("size").alias(whole))
    used = rows.join(uses, row)
    # The first n words with what stands before each of them.
    places = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1)
    head = F.array_join(F.slice(places, F.lit(1), F.col(words).cast("int")), "")
    out = used.withColumn("text", F.when(F.col(words) < F.col(whole), head).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_ids, ids``: the coded documents."""
    prepare(spark)
    coded = pieces.encode(docs.select("doc_id", "text"), read_file(PIECE_MODEL))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("language ID", language_stage),
    ("near-dedup", dedup_stage),
    ("mix", mix_stage),
    ("SentencePiece", pieces_stage),
]

#: Suffix automata, signatures and Viterbi can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{k}")
    return docs
