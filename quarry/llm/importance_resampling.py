"""Importance resampling towards a target distribution.

Documents are drawn with odds that follow how much likelier their word 1- and
2-grams are in a target corpus than in the documents themselves.

1. Every text's n-grams fall in ``BUCKETS`` buckets by checksum; each task adds
   its counts up, so a task sends at most one row a bucket.
2. Each bucket has a gain, a whole number; the array of all gains goes to the
   tasks (``BUCKETS`` numbers, whatever the input), which look a text's buckets
   up in it and write the document's mean gain: its weight.
3. The score is the weight plus Gumbel noise that the id decides; the documents
   with the highest scores are a draw without replacement.  Scores are
   written once.  The cutoff is found by bisection: each job counts, over the
   written scores, the rows above ``FANOUT`` thresholds that cut the
   interval at hand evenly, until one score is left; ids among rows of that
   score are bisected alike.  No job sorts, and no row goes to the driver.
4. Rows above the cutoff are range-partitioned by (score, id) and numbered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import consecutive_ids
from ..sources.writers import materialize
from .arrow import chunks

BUCKETS = 10_000
SEED = 7
SHARE = 25          # percent of the eligible documents
MIN_WORDS = 20
FANOUT = 64         # intervals that a counting job tells apart

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a word: lower-case letters, digits and all of multi-byte characters.
_WORD_BYTES = bytes.maketrans(_UPPER.encode(), _LOWER.encode()).translate(
    bytes(b if chr(b) in _LOWER + "0123456789" or b >= 0x80 else 0x20 for b in range(256)))


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return (text or b"").translate(_WORD_BYTES).split()


def buckets_of(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all words and of all pairs of neighbours (one space between)."""
    single = list(map(zlib.crc32, words))
    # the checksum of "a b" goes on from that of "a "
    double = map(zlib.crc32, words[1:], map(zlib.crc32, repeat(b" "), single))
    return np.fromiter((*single, *double), np.int64, max(0, 2 * len(words) - 1)) % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how often the n-grams of all texts fall in each bucket
    (buckets never hit have no row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chunks(batches, "text"):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                total += np.bincount(buckets_of(words_of(text), buckets), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["bucket", "n"])

    rows = texts.select(F.col(f"`{text_col}`").alias("text")).filter("text is not null")
    return rows.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) by bucket, from two
    :func:`bucket_counts` of B buckets; S and T are the sums of s and t."""
    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for bucket, n in counts.collect():  # at most one row a bucket
            out[bucket] = n
        return out

    s, t = dense(source), dense(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of each
    text's n-grams (0 without any)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(text)
                hit = buckets_of(words, len(gains))
                rows.append((len(words), len(hit), int(gains[hit].sum()) // len(hit) if len(hit) else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))],
                names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2 ** 32))), h the first 32 bits of
    sha256(``seed:doc_id``); a null id counts as the text ``null``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def least_of_top(values: DataFrame, col: str, k: int) -> tuple[int, int] | None:
    """The k-th greatest value of a whole-number column, and how many rows lie
    above it; None if there are fewer than k rows.

    Each job counts the rows in ``FANOUT`` even parts of the interval that holds
    the value, so an interval of 2 ** 48 numbers takes eight jobs.
    """
    c = F.col(col)
    lo, hi, n = values.agg(F.min(c), F.max(c), F.count(c)).first()
    if n < k or k < 1:
        return None
    above = 0
    while lo < hi:
        width = (hi - lo) // FANOUT + 1
        part = F.expr(f"(`{col}` - {lo}L) div {width}L").cast("int")
        counts = dict(values.filter(c.between(lo, hi)).groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect())
        for p in sorted(counts, reverse=True):  # at most FANOUT
            if above + counts[p] >= k:
                lo, hi = lo + p * width, min(hi, lo + (p + 1) * width - 1)
                break
            above += counts[p]
    return lo, above


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_features, weight, score, rank``.

    Of the N documents with at least ``min_words`` words, floor(share * N / 100)
    are drawn: the highest scores, ties to smaller ids, ranked from 1; ``rank`` is
    null for all others.  Ids are whole numbers.

    Null and empty texts, and texts without a word, have no features, weight 0 and
    are never drawn (nor are short texts).  A null id comes after all others on
    ties.  Rows that repeat an id are drawn each on their own; among rows of one
    id and one score, those with fewer features come first.  Without target texts all
    gains follow from the documents alone; empty ``docs`` give an empty result.
    Other columns are ignored, whatever their names.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    gains = bucket_gains(bucket_counts(source, buckets=buckets), bucket_counts(target, target_text_col, buckets), buckets)
    scored = materialize(weigh(source, gains).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    eligible = scored.filter(F.col("n_words") >= min_words)
    k = eligible.count() * share // 100
    cut = least_of_top(eligible, "score", k)
    columns = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    score, above = cut
    # the order of ids among equal scores: ascending, null last
    tied = eligible.filter(F.col("score") == score).select(F.expr("-cast(doc_id as long)").alias("last"))
    by_id = least_of_top(tied.filter("last is not null"), "last", k - above)
    fits = F.lit(True) if by_id is None else F.coalesce(F.col("doc_id") <= -by_id[0], F.lit(False))
    chosen = (F.col("n_words") >= min_words) & ((F.col("score") > score) | ((F.col("score") == score) & fits))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    drawn = consecutive_ids(scored.filter(chosen).select(*columns), order, "rank")
    # rows that tie in score and id at the cutoff can be more than are due
    drawn = drawn.withColumn("rank", F.when(F.col("rank") < k, F.col("rank") + 1))
    return scored.filter(~chosen).select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(drawn.select(*columns, "rank"))
