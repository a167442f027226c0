"""Stage 5 + 8 entity queries: mentions, company counts, entity sentiment
(G1, C12, C13, B7-B10, K1, D2, D3, K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import aggregates as A
from ..operators.entities import SPAN_PATTERN, company_counts, extract_entities
from ..operators.joins import entity_sentiment_counts, keep_top
from ..operators.tagger import fit_tagger, spans_in_order, tag_entities
from ..sources import fixtures as FX
from ..sources.readers import spread_rows, table
from ..sources.writers import materialize
from . import oracle_sql as S
from .cleaning import EN_LEN_SQL, english_articles
from .registry import register, sql_list, sql_str

_TITLE_SQL = S.normalize_text("trim(split_part(text, chr(10), 1))")
_CLEAN_SQL = S.light_clean(S.normalize_text("text"))

ARTICLES_SQL = f"""
a AS (SELECT d.doc_id, d.source AS industry_label, {_TITLE_SQL} AS title_clean, {_CLEAN_SQL} AS text_clean,
             CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
                  WHEN l.doc_id IS NOT NULL THEN 'neutral' END AS sentiment
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE {EN_LEN_SQL})
"""
MENTIONS_SQL = f"""
{ARTICLES_SQL},
sp AS (SELECT doc_id, industry_label, title_clean,
              unnest(regexp_extract_all(substr(title_clean || '. ' || text_clean, 1, {L.ENTITY_MAX_CHARS}),
                                        {sql_str(SPAN_PATTERN)})) AS span FROM a),
m AS (SELECT doc_id, industry_label, title_clean,
             trim({S.rx('span', T.PY_SPACE + '+')}, {sql_str(L.SPAN_STRIP_CHARS)}) AS entity_text,
             CASE WHEN contains(span, ' ') THEN 'ORG' ELSE 'MISC' END AS entity_label
      FROM sp WHERE length(trim({S.rx('span', T.PY_SPACE + '+')}, {sql_str(L.SPAN_STRIP_CHARS)})) >= 2)
"""
_NOT_WORD_OR_SPACE = T._NOT_WORD_OR_SPACE
_COMPANY_SQL = (
    "trim(" + S.title_case(
        f"array_to_string(list_filter({S.words_list(f'lower({S.rx('entity_text', _NOT_WORD_OR_SPACE)})')},"
        f" lambda w: NOT list_contains({sql_list(L.CORP_SUFFIXES)}, w)), ' ')"
    ) + ")"
)


def articles(spark, sf_dir):
    """Kept articles: id, industry (= source), ``title_clean``, ``text_clean``."""
    arts = english_articles(spark, sf_dir)
    return T.with_clean(arts, "text", "text_clean").select(
        "article_id",
        F.col("source").alias("industry_label"),
        T.normalize_text("title").alias("title_clean"),
        "text_clean",
    )


def mentions(spark, sf_dir):
    return extract_entities(articles(spark, sf_dir), keep=["article_id", "industry_label", "title_clean"])


def mentions_and_scored(spark, sf_dir):
    """ORG mentions, and articles with sentiment from the label table (null where
    unlabelled), both of articles cleaned and written once."""
    arts = materialize(articles(spark, sf_dir), "clean_articles")
    sent = FX.sentiment_from_labels(table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    scored = arts.select("article_id", "title_clean").join(sent.withColumnRenamed("doc_id", "article_id"), "article_id", "left")
    orgs = extract_entities(arts, keep=["title_clean"]).filter(F.col("entity_label") == "ORG")
    return orgs, scored


@register("entity_mentions", f"""
WITH {MENTIONS_SQL}
SELECT doc_id AS article_id, entity_text, entity_label FROM m
""")
def q_entity_mentions(spark, sf_dir):
    """G1 + C12 + B8: capitalised-span mentions of title. text[:2000]."""
    return mentions(spark, sf_dir).select("article_id", "entity_text", "entity_label")


@register("company_counts", f"""
WITH {MENTIONS_SQL},
c AS (SELECT industry_label, {_COMPANY_SQL} AS company FROM m WHERE entity_label = 'ORG')
SELECT industry_label, company, count(*) AS count FROM c
WHERE length(company) > 2 AND NOT regexp_matches(company, '(?i)ai$')
GROUP BY ALL
""", headline=True)
def q_company_counts(spark, sf_dir):
    """K1: ORG mentions normalised to companies, counted per industry."""
    return company_counts(mentions(spark, sf_dir))


@register("company_top10", f"""
WITH {MENTIONS_SQL},
c AS (SELECT industry_label, {_COMPANY_SQL} AS company FROM m WHERE entity_label = 'ORG'),
k AS (SELECT industry_label, company, count(*) AS count FROM c
      WHERE length(company) > 2 AND NOT regexp_matches(company, '(?i)ai$') GROUP BY ALL)
SELECT industry_label, company, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY industry_label ORDER BY count DESC, company) AS rank FROM k
) WHERE rank <= 10
""")
def q_company_top10(spark, sf_dir):
    """K1 + I2: ten most mentioned companies per industry."""
    counts = company_counts(mentions(spark, sf_dir))
    return A.top_k_per_group(counts, "industry_label", 10, [F.col("count").desc(), F.col("company")],
                             rank_col="rank")


ENTITY_SENTIMENT_SQL = f"""
WITH {MENTIONS_SQL},
j AS (SELECT m.entity_text, a.sentiment FROM m JOIN a ON m.title_clean IS NOT DISTINCT FROM a.title_clean
      WHERE m.entity_label = 'ORG'),
es AS (SELECT entity_text, sentiment, count(*) AS count FROM j
       WHERE entity_text IS NOT NULL AND sentiment IS NOT NULL GROUP BY ALL)
"""


@register("entity_sentiment", f"""
{ENTITY_SENTIMENT_SQL}
SELECT entity_text, sentiment, count FROM es
""", headline=True)
def q_entity_sentiment(spark, sf_dir):
    """K6: ORG mentions joined to article sentiment on the title (many to
    many, null titles match), counted per (entity, sentiment)."""
    counts = entity_sentiment_counts(*mentions_and_scored(spark, sf_dir), "title_clean")
    return counts.orderBy(F.col("count").desc(), "entity_text", "sentiment")


@register("entity_sentiment_top15", f"""
{ENTITY_SENTIMENT_SQL},
top AS (SELECT entity_text FROM es GROUP BY entity_text ORDER BY sum(count) DESC, entity_text LIMIT 15)
SELECT entity_text, sentiment, count FROM es WHERE entity_text IN (SELECT entity_text FROM top)
""")
def q_entity_sentiment_top15(spark, sf_dir):
    """K6 + D3: only the 15 entities with the largest summed count."""
    counts = entity_sentiment_counts(*mentions_and_scored(spark, sf_dir), "title_clean")
    return keep_top(counts, "entity_text", 15, weight="count")


@register("top_entities", f"""
WITH {MENTIONS_SQL}
SELECT entity_text, count(*) AS count FROM m WHERE entity_label = 'ORG'
GROUP BY entity_text ORDER BY count DESC, entity_text LIMIT 10
""")
def q_top_entities(spark, sf_dir):
    """The ten most frequent ORG mentions (ties by text)."""
    orgs = mentions(spark, sf_dir).filter(F.col("entity_label") == "ORG")
    return A.value_counts(orgs, "entity_text", k=10)


TAGGER_EXAMPLES = 2000  # articles that the tagger is fitted on, by hash of the id


def rule_examples(texts, n: int = TAGGER_EXAMPLES):
    """At most ``n`` articles with the spans of the capitalised-word rule, which stand in
    for hand-made labels."""
    sample = spread_rows(texts.orderBy(F.xxhash64("article_id"), "article_id").limit(n).select("text"))
    spans = F.regexp_extract_all("text", F.lit(SPAN_PATTERN), 0)
    named = sample.withColumn("mentions", F.transform(spans, lambda s: F.struct(
        s.alias("span"), F.when(s.contains(" "), "ORG").otherwise("MISC").alias("label"))))
    return named.withColumn("spans", spans_in_order("text", "mentions"))


@register("tagged_mentions", None)
def q_tagged_mentions(spark, sf_dir):
    """G1 by the sequence tagger: spans of ``title. text``, whole, with their places and the
    mean probability of their tags.  The tagger learns from the spans that the rule finds in
    at most ``TAGGER_EXAMPLES`` articles and is applied to all articles."""
    arts = articles(spark, sf_dir)
    texts = materialize(arts.select("article_id", F.concat(
        T.null_to_empty("title_clean"), F.lit(". "), T.null_to_empty("text_clean")).alias("text")), "tagger_texts")
    model, _ = fit_tagger(rule_examples(texts), "text", "spans", ["ORG", "MISC"])
    return tag_entities(texts, "text", model, keep=["article_id"])
