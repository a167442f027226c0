"""F-section: topic terms, class-based TF-IDF, keywords, topic similarity,
centroid assignment, representative documents, dimension reduction and
density clustering - as DataFrame algebra.

Shapes: documents carry ``(doc_id, topic, text)``; term tables are long
``(topic, term, ...)``; vectors are ``array<float>``.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import ngrams, tokens
from ..sources.writers import materialize
from .aggregates import consecutive_ids, top_k_per_group
from .joins import dot

# Bytes of the centroids that one scoring pass holds.
CENTROID_BLOCK_BYTES = 64 << 20


def topic_stopwords(extra: Sequence[str] = L.DOMAIN_STOPWORDS) -> list[str]:
    """Base English list union the domain words."""
    return sorted(set(L.BASE_STOPWORDS) | set(extra))


def doc_terms(df: DataFrame, text: Column | str, keep: Sequence[str], stopwords: Sequence[str],
              n_max: int = L.NGRAM_RANGE[1], positions: bool = False) -> DataFrame:
    """One row per term occurrence: ``keep`` columns + ``term`` (C20), with
    ``positions`` also its place ``pos`` and the text's ``n_tokens`` (n_max = 1).

    Tokens are materialised once as a column; stop words go through Spark
    ML's ``StopWordsRemover`` (hash-set lookup, order and repeats kept); the
    n-grams are built from the column reference.  ``explode_outer`` + a null
    filter keeps Catalyst from pushing an inferred ``size > 0`` predicate
    below the tokenising projection.
    """
    t = F.col(text) if isinstance(text, str) else text
    tok = df.select(*keep, tokens(t).alias("_raw"))
    tok = StopWordsRemover(inputCol="_raw", outputCol="_tok", stopWords=list(stopwords),
                           caseSensitive=True).transform(tok)
    if positions:
        placed = tok.select(*keep, F.size("_tok").alias("n_tokens"), F.posexplode_outer("_tok").alias("pos", "term"))
        return placed.filter(F.col("term").isNotNull())
    grams = tok.select(*keep, F.explode_outer(ngrams(F.col("_tok"), n_max)).alias("term"))
    return grams.filter(F.col("term").isNotNull())


def term_counts(occ: DataFrame) -> DataFrame:
    """H8: corpus frequency of every term."""
    return occ.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def document_frequency(pairs: DataFrame) -> DataFrame:
    """Number of units (documents or topics) per term, from a table with one
    row per (unit, term) - e.g. ``topic_term_counts`` or distinct pairs."""
    return pairs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def unit_term_pairs(occ: DataFrame, unit: str) -> DataFrame:
    """Distinct (unit, term) pairs of an occurrence table (partial-aggregated)."""
    return occ.select(unit, "term").distinct()


def _df_bound(v, n_units):
    return F.lit(float(v)) * n_units if isinstance(v, float) else F.lit(v)


def vocabulary(pairs: DataFrame, unit: str, min_df: float = L.MIN_DF, max_df: float = L.MAX_DF,
               n_units: Column | None = None) -> DataFrame:
    """M4: terms whose document frequency lies within ``[min_df, max_df]``.

    ``pairs`` has one row per (unit, term).  Integers are counts, floats are
    shares of the number of units (vectoriser semantics: every document of
    the fit counts, also one without terms - pass ``n_units``, e.g. a scalar
    subquery over the documents; by default the units present in ``pairs``).
    """
    dfreq = document_frequency(pairs)
    if n_units is None:
        n_units = pairs.select(F.count_distinct(unit)).scalar()
    return dfreq.filter((F.col("df") >= _df_bound(min_df, n_units)) & (F.col("df") <= _df_bound(max_df, n_units)))


def restrict_to_vocabulary(tf: DataFrame, min_df: float, max_df: float, n_units: Column) -> DataFrame:
    """Rows of a (unit, term, ...) table whose term lies in the vocabulary.

    The document frequency is a count over a window partitioned by term, so
    the table is shuffled once by term and filtered in place - no second pass
    over the table and no join back.
    """
    dfc = F.count(F.lit(1)).over(Window.partitionBy("term"))
    out = tf.withColumn("_df", dfc)
    return out.filter((F.col("_df") >= _df_bound(min_df, n_units)) & (F.col("_df") <= _df_bound(max_df, n_units))
                      ).drop("_df")


def topic_term_counts(occ: DataFrame, topic: str = "topic") -> DataFrame:
    """tf(c, t): occurrences of each term per class (one shuffle, partial agg)."""
    return occ.groupBy(topic, "term").agg(F.count(F.lit(1)).alias("tf"))


def class_tfidf(tf: DataFrame, topic: str = "topic", vocab: DataFrame | None = None) -> DataFrame:
    """M5: class-based TF-IDF per (topic, term) from ``topic_term_counts``.

    w(c, t) = tf(c, t) / sum_t tf(c, t) * ln(1 + A / f(t)), where f(t) is the
    term's frequency over all classes and A the average number of words per
    class (truncated to an integer).  Everything runs on the aggregated
    (topic x vocabulary) table; A is a scalar subquery.
    """
    if vocab is not None:
        tf = tf.join(vocab.select("term"), "term", "left_semi")
    # class totals: one row per topic, joined back rather than windowed, so a
    # topic that holds most of the vocabulary can be split over tasks
    totals = tf.groupBy(topic).agg(F.sum("tf").alias("class_total"))
    tf = tf.join(totals, topic)
    tf = tf.withColumn("term_total", F.sum("tf").over(Window.partitionBy("term")))  # <= one row per topic
    avg_words = totals.select(F.floor(F.avg("class_total"))).scalar()
    idf = F.log(F.lit(1.0) + avg_words / F.col("term_total"))
    out = tf.withColumn("idf", idf).withColumn("weight", F.col("tf") / F.col("class_total") * F.col("idf"))
    return out.select(topic, "term", "tf", "idf", "weight")


def representative_texts(occ: DataFrame, weights: DataFrame, k: int = 3, topic: str = "topic",
                         id_col: str = "doc_id") -> DataFrame:
    """M8 for text topics: the ``k`` documents whose c-TF-IDF vector
    (term counts x idf) is most cosine-similar to their topic's vector.

    Only equi-joins on (topic, term) and aggregates: occurrences are joined to
    the topic weights (one row per topic and term), partial sums give dot products and norms.
    """
    w = weights.select(topic, "term", "idf", "weight")
    dt = occ.join(w, [topic, "term"]).groupBy(id_col, topic, "term").agg(  # most occurrences are outside the vocabulary
        F.count(F.lit(1)).alias("n"), F.first("idf").alias("idf"), F.first("weight").alias("weight"))
    dv = dt.withColumn("v", F.col("n") * F.col("idf"))
    per_doc = dv.groupBy(id_col, topic).agg(
        F.sum(F.col("v") * F.col("weight")).alias("dot"), F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("dn"))
    wn = weights.groupBy(topic).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("wn"))
    sim = per_doc.join(wn, topic).withColumn("similarity", F.col("dot") / (F.col("dn") * F.col("wn")))
    # equal up to the order of summation counts as a tie
    top = top_k_per_group(sim, topic, k, [F.round("similarity", 9).desc(), F.col(id_col)], rank_col="rank")
    return top.select(topic, "rank", id_col, "similarity")


def window_topics(docs: DataFrame, weights: DataFrame, text: str, stopwords: Sequence[str], window: int = 4,
                  min_similarity: float = 0.0, topic: str = "topic", id_col: str = "doc_id") -> DataFrame:
    """M9 from the texts: ``id, topic, score, share`` of each document's topics.

    Windows of ``window`` tokens slide over the text (a shorter text is one
    window).  A window's idf vector is compared (cosine) with each topic's c-TF-IDF
    vector; similarities above ``min_similarity`` add up to the document's score, and
    ``share`` is its part of the document's whole.  Documents that share no
    term with any topic have no row.  Equi-joins on the term and partial sums only.
    """
    idf = weights.select("term", "idf").distinct()
    size = weights.groupBy(topic).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_size"))
    tok = doc_terms(docs.select(id_col, text), text, [id_col], stopwords, 1, positions=True)
    last = F.greatest(F.col("n_tokens") - window, F.lit(0))
    wins = tok.join(idf, "term").select(id_col, "term", "idf", F.explode(F.sequence(
        F.greatest(F.col("pos") - window + 1, F.lit(0)), F.least(F.col("pos"), last))).alias("_win"))
    vec = wins.groupBy(id_col, "_win", "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("_v"))
    norm = vec.groupBy(id_col, "_win").agg(F.sqrt(F.sum(F.col("_v") * F.col("_v"))).alias("_norm"))
    dots = vec.join(weights.select(topic, "term", "weight"), "term").groupBy(id_col, "_win", topic).agg(
        F.sum(F.col("_v") * F.col("weight")).alias("_dot"))
    sim = dots.join(norm, [id_col, "_win"]).join(size, topic).withColumn("_sim", F.col("_dot") / (F.col("_norm") * F.col("_size")))
    score = sim.filter(F.col("_sim") > min_similarity).groupBy(id_col, topic).agg(F.sum("_sim").alias("score"))
    whole = score.groupBy(id_col).agg(F.sum("score").alias("_whole"))
    return score.join(whole, id_col).select(id_col, topic, "score", (F.col("score") / F.col("_whole")).alias("share"))


def topic_keywords(weights: DataFrame, n: int = L.TOP_N_WORDS, topic: str = "topic") -> DataFrame:
    """M6: the ``n`` highest-weighted terms per topic (ties by term), as an
    ordered array and a comma-joined string."""
    top = top_k_per_group(weights, topic, n, [F.col("weight").desc(), F.col("term")], rank_col="rank")
    agg = top.groupBy(topic).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_r"))
    words = F.transform(F.col("_r"), lambda s: s["term"])
    return agg.select(topic, words.alias("words"), F.array_join(words, ", ").alias("keywords"))


def example_docs(rep: DataFrame, topic: str = "topic", id_col: str = "doc_id") -> DataFrame:
    """M7: the representatives of each topic, best first, joined by `` | ``."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(id_col).cast("string").alias("id"))))
    return rep.groupBy(topic).agg(F.array_join(F.transform(ordered, lambda r: r["id"]), " | ").alias("representative_docs"))


def topic_info(docs: DataFrame, keywords: DataFrame, topic: str = "topic", name_words: int = 4) -> DataFrame:
    """M7: topic id, size, ``<id>_<w1>_..._<w4>`` name and keyword string."""
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("count"))
    name = F.concat_ws("_", F.col(topic).cast("string"), F.array_join(F.slice("words", 1, name_words), "_"))
    return sizes.join(keywords, topic, "left").select(topic, "count", name.alias("name"), "keywords")


def topic_similarity(weights: DataFrame, topic: str = "topic") -> DataFrame:
    """Cosine similarity of the topics' term-weight vectors, for all pairs
    of topics that share a term.

    Weights are scaled to unit length per topic; the products of two topics'
    weights for a term meet by an equi-join on the term and are summed with
    partial sums.  Each pair is formed once and mirrored.
    """
    norms = weights.groupBy(topic).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_n"))
    unit = weights.join(norms, topic).select(F.col(topic).alias("topic_a"), "term", (F.col("weight") / F.col("_n")).alias("_a"))
    other = unit.select(F.col("topic_a").alias("topic_b"), F.col("term").alias("_t"), F.col("_a").alias("_b"))
    half = unit.join(other, (F.col("term") == F.col("_t")) & (F.col("topic_a") <= F.col("topic_b"))).groupBy(
        "topic_a", "topic_b").agg(F.sum(F.col("_a") * F.col("_b")).alias("similarity"))
    mirrored = half.filter("topic_a < topic_b").select(
        F.col("topic_b").alias("topic_a"), F.col("topic_a").alias("topic_b"), "similarity")
    return half.unionByName(mirrored)


def centroids(df: DataFrame, vec: str = "embedding", topic: str = "topic", normalize: bool = True) -> DataFrame:
    """Mean vector per topic (``Summarizer``, partial-aggregated), optionally
    scaled to unit length so a dot product is the cosine."""
    c = df.groupBy(topic).agg(Summarizer.mean(array_to_vector(F.col(vec))).alias("_m"))
    arr = vector_to_array("_m")
    if normalize:
        norm = F.sqrt(dot(arr, arr))
        arr = F.transform(arr, lambda x: x / norm)
    return c.select(topic, arr.alias("centroid"))


def assign_nearest(df: DataFrame, cents: DataFrame, vec: str = "embedding", out: str = "topic",
                   score: str = "topic_score", topic: str = "topic") -> DataFrame:
    """M3: topic of the nearest centroid by dot product (smallest id on ties).

    Centroids come in blocks of at most ``CENTROID_BLOCK_BYTES``, ascending by
    id; each pass scores every vector against one block with a matrix product
    and keeps the better of that and the best so far.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    spark = df.sparkSession
    shape = cents.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("centroid")).alias("d")).first()
    rows_per_block = max(1, CENTROID_BLOCK_BYTES // (8 * max(1, shape["d"] or 1)))
    id_type = cents.schema[topic].dataType
    names = [f.name for f in df.schema.fields if f.name not in (out, score)]
    schema = StructType([df.schema[c] for c in names] + [StructField(out, id_type), StructField(score, DoubleType())])

    def scorer(bc):
        def run(batches):
            ids, m = bc.value
            for pdf in batches:
                pdf = pdf.copy()
                have = pdf[vec].notna().to_numpy()
                best_id, best = pdf[out].to_numpy(dtype=object), pdf[score].to_numpy(dtype=np.float64, na_value=np.nan)
                if have.any() and len(ids):
                    x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec].to_numpy()[have]])
                    s = x @ m.T
                    j = s.argmax(axis=1)  # first maximum = smallest topic id
                    top = s[np.arange(len(j)), j]
                    better = np.isnan(best[have]) | (top > best[have])
                    at = np.flatnonzero(have)[better]
                    best_id[at], best[at] = ids[j[better]], top[better]
                pdf[out], pdf[score] = best_id, best
                yield pdf

        return run

    res = df.select(*names, F.lit(None).cast(id_type).alias(out), F.lit(None).cast("double").alias(score))
    ordered = cents.select(topic, "centroid").orderBy(topic)
    for first in range(0, max(1, shape["n"]), rows_per_block):
        block = ordered.offset(first).limit(rows_per_block).collect()
        ids = np.array([r[0] for r in block])
        mat = np.array([r[1] for r in block], dtype=np.float64).reshape(len(block), -1)
        res = res.mapInPandas(scorer(spark.sparkContext.broadcast((ids, mat))), schema)
    return res


def reduce_outliers(df: DataFrame, cents: DataFrame, vec: str = "embedding", topic: str = "topic") -> DataFrame:
    """M9: documents in topic -1 move to their nearest topic; others stay."""
    real = cents.filter(F.col(topic) != -1)
    moved = assign_nearest(df, real, vec, out="_nearest", score="_s", topic=topic)
    return moved.withColumn(topic, F.when(F.col(topic) == -1, F.col("_nearest")).otherwise(F.col(topic))).drop(
        "_nearest", "_s")


def representative_docs(df: DataFrame, cents: DataFrame, k: int = 3, vec: str = "embedding",
                        topic: str = "topic", id_col: str = "doc_id") -> DataFrame:
    """M8: the ``k`` documents most similar to their own topic centroid."""
    j = df.join(cents, topic)  # centroids: one row per topic, planner broadcasts when small
    j = j.withColumn("similarity", dot(F.col(vec), F.col("centroid")))
    top = top_k_per_group(j, topic, k, [F.col("similarity").desc(), F.col(id_col)], rank_col="rank")
    return top.select(topic, "rank", id_col, "similarity")


def reduce_dims(df: DataFrame, vec: str = "embedding", k: int = L.REDUCED_DIMS, out: str = "reduced",
                seed: int = 42) -> DataFrame:
    """M1: principal components (distributed Gramian in Spark ML)."""
    v = df.withColumn("_v", array_to_vector(F.col(vec)))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v)
    return model.transform(v).withColumn(out, vector_to_array("_p")).drop("_v", "_p")


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Min-label propagation over an undirected graph until no label changes.

    ``nodes``: column ``node``; ``edges``: ``src``, ``dst`` (both directions
    present).  Every round is one join + one aggregate; the label table is
    written to the checkpoint folder, so that no round is computed twice.  Returns
    ``node, component`` with the component labelled by its smallest node.
    """
    labels = nodes.select("node", F.col("node").alias("component"))
    while True:
        via = edges.join(labels.withColumnRenamed("node", "dst"), "dst").select(
            F.col("src").alias("node"), "component")
        new = labels.unionByName(via).groupBy("node").agg(F.min("component").alias("component"))
        new = materialize(new, "components")
        changed = new.join(labels.withColumnRenamed("component", "_old"), "node").filter(
            F.col("component") < F.col("_old")).limit(1).count()
        labels = new
        if not changed:
            return labels
