"""Stage 6 queries: dictionary tags per industry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import aggregates as A
from ..operators.tagging import tag_articles, tag_counts
from . import oracle_sql as S
from .cleaning import EN_LEN_SQL, english_articles
from .registry import register, sql_list, sql_str

# Fixture dictionary: phrases that actually occur in the test documents
# (license lines, insults, invented words containing "llm"/"rpa").
FIXTURE_TAGS = {
    "ai_terms": ["llm", "rpa", "token"],
    "insult": ["idiot", "stupid", "worthless", "hate"],
    "licensing": ["license", "apache", "mit license", "rights reserved"],
}

CLEAN_SQL = S.light_clean(S.normalize_text("text"))
ARTICLES_SQL = f"SELECT source AS industry_label, {CLEAN_SQL} AS text_clean FROM documents WHERE {EN_LEN_SQL}"


def clean_articles(spark, sf_dir):
    """A1 -> B2 -> B3 -> C1 -> C5: the kept articles with ``text_clean``;
    the source plays the industry label."""
    arts = english_articles(spark, sf_dir)
    return T.with_clean(arts, "text", "text_clean").select(
        "article_id", F.col("source").alias("industry_label"), "text_clean")


def all_phrases(dictionary) -> list[str]:
    return [p for label in sorted(dictionary) for p in dictionary[label]]


def with_phrases(articles, dictionary):
    """Fixture: the test documents hold none of the corpus dictionaries'
    phrases, so each article gets one appended, chosen by its id."""
    phrases = all_phrases(dictionary)
    at = F.pmod(F.col("article_id"), F.lit(len(phrases))).cast("int")
    phrase = F.get(F.array(*[F.lit(p) for p in phrases]), at)
    return articles.withColumn("text_clean", F.concat("text_clean", F.lit(" "), phrase))


def _counts_sql(dictionary, tag_col, mode="substring", articles=ARTICLES_SQL):
    return f"""
WITH a AS ({articles}),
t AS ({S.tag_union('a', 'industry_label', 'text_clean', dictionary, tag_col, mode)})
SELECT industry_label, {tag_col}, count(*) AS count FROM t GROUP BY industry_label, {tag_col}
"""


def _counts(articles, dictionary, tag_col, mode="substring", engine="contains"):
    tagged = tag_articles(articles, "text_clean", {tag_col: dictionary}, mode=mode, engine=engine)
    counts = tag_counts(tagged, "industry_label", tag_col)
    return counts.orderBy(F.col("industry_label"), F.col("count").desc(), F.col(tag_col))


def impact_counts(articles):
    """K2 of cleaned articles (``article_id, industry_label, text_clean``)."""
    return _counts(with_phrases(articles, L.IMPACT_KEYWORDS), L.IMPACT_KEYWORDS, "impact_modes")


def technology_counts(articles):
    """K3 of cleaned articles (``article_id, industry_label, text_clean``)."""
    return _counts(with_phrases(articles, L.TECHNOLOGY_KEYWORDS), L.TECHNOLOGY_KEYWORDS, "technologies")


@register("tag_counts", _counts_sql(FIXTURE_TAGS, "tag"), headline=True)
def q_tag_counts(spark, sf_dir):
    """Flagship: clean -> tag -> explode -> count per (industry, tag)."""
    return _counts(clean_articles(spark, sf_dir), FIXTURE_TAGS, "tag")


@register("tag_counts_automaton", _counts_sql(FIXTURE_TAGS, "tag"))
def q_tag_counts_automaton(spark, sf_dir):
    """Same result with one alternation per label instead of a chain of
    ``contains``."""
    return _counts(clean_articles(spark, sf_dir), FIXTURE_TAGS, "tag", engine="rlike")


@register("tag_counts_word", _counts_sql(FIXTURE_TAGS, "tag", mode="word"))
def q_tag_counts_word(spark, sf_dir):
    return _counts(clean_articles(spark, sf_dir), FIXTURE_TAGS, "tag", mode="word")


def _phrase_articles_sql(dictionary):
    phrases = all_phrases(dictionary)
    return (f"SELECT source AS industry_label, {CLEAN_SQL} || ' ' || {sql_list(phrases)}[CAST(doc_id % {len(phrases)} AS INTEGER) + 1]"
            f" AS text_clean FROM documents WHERE {EN_LEN_SQL}")


IMPACT_SQL = _counts_sql(L.IMPACT_KEYWORDS, "impact_modes", articles=_phrase_articles_sql(L.IMPACT_KEYWORDS))
TECHNOLOGY_SQL = _counts_sql(L.TECHNOLOGY_KEYWORDS, "technologies", articles=_phrase_articles_sql(L.TECHNOLOGY_KEYWORDS))


@register("impact_counts", IMPACT_SQL, headline=True)
def q_impact_counts(spark, sf_dir):
    """K2 with the impact dictionary."""
    return impact_counts(clean_articles(spark, sf_dir))


@register("technology_counts", TECHNOLOGY_SQL)
def q_technology_counts(spark, sf_dir):
    """K3 with the technology dictionary."""
    return technology_counts(clean_articles(spark, sf_dir))


@register("technology_top3", f"""
WITH c AS ({TECHNOLOGY_SQL})
SELECT industry_label, technologies, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY industry_label ORDER BY count DESC, technologies) AS rank FROM c
) WHERE rank <= 3
""")
def q_technology_top3(spark, sf_dir):
    """K3 + I2: three most frequent technologies per industry."""
    return A.top_k_per_group(q_technology_counts(spark, sf_dir), "industry_label", 3,
                             [F.col("count").desc(), F.col("technologies")], rank_col="rank")


TECHNOLOGIES = sorted(L.TECHNOLOGY_KEYWORDS)


@register("technology_heatmap", f"""
WITH c AS ({TECHNOLOGY_SQL})
SELECT industry_label,
  {", ".join(f'CAST(sum(CASE WHEN technologies = {sql_str(t)} THEN count ELSE 0 END) AS BIGINT) AS "{t}"' for t in TECHNOLOGIES)}
FROM c GROUP BY industry_label
""")
def q_technology_heatmap(spark, sf_dir):
    """K3 + J6: industry x technology table, missing -> 0."""
    return A.pivot_counts(q_technology_counts(spark, sf_dir), "industry_label", "technologies", TECHNOLOGIES)


@register("tag_top3", f"""
WITH c AS ({_counts_sql(FIXTURE_TAGS, "tag")})
SELECT industry_label, tag, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY industry_label ORDER BY count DESC, tag) AS rank FROM c
) WHERE rank <= 3
""")
def q_tag_top3(spark, sf_dir):
    """Three most frequent tags per industry (ties by label)."""
    counts = tag_counts(tag_articles(clean_articles(spark, sf_dir), "text_clean", {"tag": FIXTURE_TAGS}),
                        "industry_label", "tag")
    return A.top_k_per_group(counts, "industry_label", 3, [F.col("count").desc(), F.col("tag")], rank_col="rank")


_PIVOT_COLS = sorted(FIXTURE_TAGS)


@register("tag_pivot", f"""
WITH c AS ({_counts_sql(FIXTURE_TAGS, "tag")})
SELECT industry_label,
  {", ".join(f"CAST(sum(CASE WHEN tag = {sql_str(t)} THEN count ELSE 0 END) AS BIGINT) AS {t}" for t in _PIVOT_COLS)}
FROM c GROUP BY industry_label
""")
def q_tag_pivot(spark, sf_dir):
    """Industry x tag table, missing -> 0, explicit column list."""
    counts = tag_counts(tag_articles(clean_articles(spark, sf_dir), "text_clean", {"tag": FIXTURE_TAGS}),
                        "industry_label", "tag")
    return A.pivot_counts(counts, "industry_label", "tag", _PIVOT_COLS)


@register("tag_totals", f"""
WITH c AS ({IMPACT_SQL})
SELECT impact_modes, CAST(sum(count) AS BIGINT) AS total FROM c GROUP BY impact_modes
""")
def q_tag_totals(spark, sf_dir):
    """K4/H9: impact totals over all industries, largest first."""
    return A.sum_by(q_impact_counts(spark, sf_dir), "impact_modes").orderBy(F.col("total").desc(), "impact_modes")


@register("top_label_per_industry", f"""
WITH c AS ({_counts_sql(FIXTURE_TAGS, "tag")}),
best AS (
  SELECT industry_label, tag, count FROM (
    SELECT *, row_number() OVER (PARTITION BY industry_label ORDER BY count DESC, tag) AS rn FROM c
  ) WHERE rn = 1
)
SELECT industry_label, tag, count FROM best ORDER BY count DESC, industry_label LIMIT 10
""")
def q_top_label_per_industry(spark, sf_dir):
    """The most frequent tag per industry (first label wins ties), then
    the ten industries with the largest such count."""
    counts = tag_counts(tag_articles(clean_articles(spark, sf_dir), "text_clean", {"tag": FIXTURE_TAGS}),
                        "industry_label", "tag")
    ranked = A.top_k_per_group(counts, "industry_label", 1, [F.col("count").desc(), F.col("tag")])
    return A.top_k(ranked, 10, [F.col("count").desc(), F.col("industry_label")]).select("industry_label", "tag", "count")
