"""Stage 1-2 queries: filters, normalisation, light clean, dedup, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import filters as FL
from ..sources import fixtures as FX
from ..sources.readers import table
from . import oracle_sql as S
from .registry import register

EN_LEN_SQL = f"lower(lang) = 'en' AND length(coalesce(text, '')) BETWEEN {L.MIN_TEXT_LEN} AND {L.MAX_TEXT_LEN}"


def english_articles(spark, sf_dir, *extra):
    """documents -> articles -> B2 language -> B3 raw length."""
    docs = FX.articles(spark, sf_dir)
    return FL.filter_length(FL.filter_language(docs))


@register("lang_len_filter", f"""
SELECT doc_id AS article_id, source, length(text) AS text_len
FROM documents WHERE {EN_LEN_SQL}
""")
def q_lang_len_filter(spark, sf_dir):
    return english_articles(spark, sf_dir).select("article_id", "source", F.length("text").alias("text_len"))


@register("normalize_text", f"""
SELECT doc_id AS article_id, md5({S.normalize_text('text')}) AS text_md5,
       length({S.normalize_text('text')}) AS clean_len
FROM documents
""")
def q_normalize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"], spread=True)
    clean = T.with_steps(docs.withColumnRenamed("doc_id", "article_id"), "text", "t", T.NORMALIZE_STEPS)
    return clean.select("article_id", F.md5("t").alias("text_md5"), F.length("t").alias("clean_len"))


@register("light_clean", f"""
SELECT doc_id AS article_id, md5({S.light_clean('text')}) AS text_md5,
       length({S.light_clean('text')}) AS clean_len
FROM documents
""")
def q_light_clean(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"], spread=True)
    clean = T.with_steps(docs.withColumnRenamed("doc_id", "article_id"), "text", "t", T.LIGHT_CLEAN_STEPS)
    return clean.select("article_id", F.md5("t").alias("text_md5"), F.length("t").alias("clean_len"))


@register("clean_chain", f"""
SELECT doc_id AS article_id, md5({S.light_clean(S.normalize_text('text'))}) AS text_md5
FROM documents WHERE {EN_LEN_SQL}
""")
def q_clean_chain(spark, sf_dir):
    """Stages 1+2 on the kept articles: normalise (NFKC incl.) then light clean."""
    arts = english_articles(spark, sf_dir)
    return T.with_clean(arts, "text", "t").select("article_id", F.md5("t").alias("text_md5"))


@register("dedup_first_text", """
SELECT doc_id AS article_id, source, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
) WHERE rn = 1
""")
def q_dedup_first_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    first = FL.dedup_first(docs, ["text"], "doc_id")
    return first.select(F.col("doc_id").alias("article_id"), "source", F.md5("text").alias("text_md5"))


_URL_KEY_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), "
    "'^(www\\.|m\\.)', ''), '[?#].*$', '')"
)


@register("dedup_url", f"""
WITH both_copies AS (
  SELECT page_id, url, html, CAST(0 AS BIGINT) AS copy FROM pages
  UNION ALL
  SELECT page_id, {_URL_KEY_SQL} AS url, html, CAST(1 AS BIGINT) AS copy FROM pages
)
SELECT url, page_id, copy FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY copy, page_id) AS rn FROM both_copies
) WHERE rn = 1
""")
def q_dedup_url(spark, sf_dir):
    """I4 on url: the pages plus a copy whose url is the normalised key, so
    that the two copies of a page collide where the url was already bare."""
    pages = table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    both = pages.withColumn("copy", F.lit(0)).unionByName(
        pages.withColumn("url", FX.url_key("url")).withColumn("copy", F.lit(1))
    )
    first = FL.dedup_first(both, ["url"], F.struct("copy", "page_id"))
    return first.select("url", "page_id", "copy")


@register("time_report", """
SELECT CAST(count(date) AS DOUBLE) * 100.0 / count(*) AS parse_success_pct,
       strftime(min(date), '%Y-%m-%d %H:%M:%S+00:00') AS min_date_utc,
       strftime(max(date), '%Y-%m-%d %H:%M:%S+00:00') AS max_date_utc,
       count(*) FILTER (WHERE date IS NULL) AS n_missing_date
FROM (SELECT CAST(DATE '2022-01-01' + CAST(doc_id % 1502 AS INTEGER) AS TIMESTAMP) AS date FROM documents)
""")
def q_time_report(spark, sf_dir):
    return A.time_report(FX.articles(spark, sf_dir), "date")


@register("null_profile", """
WITH j AS (
  SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), c AS (
  SELECT 'doc_id' AS column_name, 'bigint' AS dtype, count(*) FILTER (WHERE doc_id IS NULL) AS null_count, count(*) AS n FROM j
  UNION ALL SELECT 'lang', 'string', count(*) FILTER (WHERE lang IS NULL), count(*) FROM j
  UNION ALL SELECT 'source', 'string', count(*) FILTER (WHERE source IS NULL), count(*) FROM j
  UNION ALL SELECT 'quality', 'int', count(*) FILTER (WHERE quality IS NULL), count(*) FROM j
  UNION ALL SELECT 'toxic', 'int', count(*) FILTER (WHERE toxic IS NULL), count(*) FROM j
)
SELECT column_name, dtype, null_count, null_count / n AS null_share FROM c
""")
def q_null_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "lang", "source"])
    labels = table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return A.null_profile(docs.join(labels, "doc_id", "left"), ["doc_id", "lang", "source", "quality", "toxic"])


LENGTH_PS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


@register("length_percentiles", f"""
SELECT p, round(value, 6) AS value FROM (
  SELECT unnest(ps) AS p, unnest(qs) AS value FROM (
    SELECT {LENGTH_PS}::DOUBLE[] AS ps, quantile_cont(length(text), {LENGTH_PS}::DOUBLE[]) AS qs FROM documents
  )
)
""")
def q_length_percentiles(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"])
    pct = A.percentiles(docs, F.length("text"), LENGTH_PS)
    return pct.withColumn("value", F.round("value", 6))  # interpolation differs in the last bit across engines


@register("describe_word_counts", f"""
WITH w AS (SELECT len({S.words_list('text')}) AS n FROM documents)
SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min,
       quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, max(n) AS max
FROM w
""")
def q_describe_word_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"], spread=True)
    d = A.describe(docs.select(F.size(T.words("text")).cast("long").alias("n")), "n")
    return d.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("value_counts_lang", """
SELECT lang, count(*) AS count FROM documents GROUP BY lang
""")
def q_value_counts_lang(spark, sf_dir):
    return A.value_counts(table(spark, sf_dir, "documents", ["lang"]), "lang")


@register("sample_articles", None)
def q_sample_articles(spark, sf_dir):
    """Reproducible 100-row sample (rows-only check: the sample is seeded
    by a hash, so no independent SQL has the same rows)."""
    return A.sample_n(FX.articles(spark, sf_dir).select("article_id", "url", "title"), 100, "article_id")
