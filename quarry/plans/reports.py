"""Stage 8 reports: sentiment by topic / month, shares, top-k variants,
dashboard extracts (K5, K7, K8, K9, H2, H10, H12, I1, J7, D3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import aggregates as A
from ..operators.joins import keep_top
from ..sources import fixtures as FX
from ..sources.readers import table
from .cleaning import EN_LEN_SQL, english_articles
from .registry import register

SENTIMENTS = ["negative", "neutral", "positive"]

SCORED_SQL = f"""
SELECT d.doc_id AS article_id, d.source AS topic_name,
       CAST(DATE '2022-01-01' + CAST(d.doc_id % 1502 AS INTEGER) AS DATE) AS date,
       CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
            WHEN l.doc_id IS NOT NULL THEN 'neutral' END AS sentiment
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE {EN_LEN_SQL}
"""


def scored_articles(spark, sf_dir):
    """Kept articles with a sentiment label (null where no label exists);
    the source plays the topic name."""
    arts = english_articles(spark, sf_dir).select("article_id", F.col("source").alias("topic_name"), "date")
    sent = FX.sentiment_from_labels(table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    return arts.join(sent.withColumnRenamed("doc_id", "article_id"), "article_id", "left")


def _topic_sentiment(df):
    counts = A.count_by(df, "topic_name", "sentiment")
    return A.add_share(counts, "topic_name").orderBy("topic_name", F.col("count").desc(), "sentiment")


@register("topic_sentiment", f"""
WITH s AS ({SCORED_SQL}),
c AS (SELECT topic_name, sentiment, count(*) AS count FROM s
      WHERE topic_name IS NOT NULL AND sentiment IS NOT NULL GROUP BY ALL)
SELECT topic_name, sentiment, count, CAST(sum(count) OVER (PARTITION BY topic_name) AS BIGINT) AS total,
       count / sum(count) OVER (PARTITION BY topic_name) AS pct
FROM c
""", headline=True)
def q_topic_sentiment(spark, sf_dir):
    """K5: sentiment counts per topic with the topic total and share."""
    return _topic_sentiment(scored_articles(spark, sf_dir))


@register("topic_sentiment_top12", f"""
WITH s AS ({SCORED_SQL}),
top AS (SELECT topic_name FROM s WHERE topic_name IS NOT NULL GROUP BY topic_name
        ORDER BY count(*) DESC, topic_name LIMIT 12),
c AS (SELECT topic_name, sentiment, count(*) AS count FROM s
      WHERE topic_name IN (SELECT topic_name FROM top) AND sentiment IS NOT NULL GROUP BY ALL)
SELECT topic_name, sentiment, count, CAST(sum(count) OVER (PARTITION BY topic_name) AS BIGINT) AS total,
       count / sum(count) OVER (PARTITION BY topic_name) AS pct
FROM c
""")
def q_topic_sentiment_top12(spark, sf_dir):
    """K5 variant: only the 12 topics with the most articles (D3 semi-join)."""
    return _topic_sentiment(keep_top(scored_articles(spark, sf_dir), "topic_name", 12))


@register("sentiment_over_time", f"""
WITH s AS ({SCORED_SQL}),
c AS (SELECT last_day(date) AS m, sentiment, count(*) AS count FROM s WHERE sentiment IS NOT NULL GROUP BY ALL)
SELECT strftime(m, '%Y-%m-%d') AS date, sentiment, count,
       CAST(sum(count) OVER (PARTITION BY m) AS BIGINT) AS total, count / sum(count) OVER (PARTITION BY m) AS pct
FROM c
""", headline=True)
def q_sentiment_over_time(spark, sf_dir):
    """K7: monthly (month-end) sentiment counts with month total and share."""
    counts = A.count_by_month(scored_articles(spark, sf_dir), "date", "sentiment")
    out = A.add_share(counts, "date")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "sentiment", "count", "total", "pct")


@register("month_share", """
WITH c AS (SELECT last_day(o_orderdate) AS m, o_orderstatus, count(*) AS count FROM orders GROUP BY ALL)
SELECT strftime(m, '%Y-%m-%d') AS month, o_orderstatus, count,
       CAST(sum(count) OVER (PARTITION BY m) AS BIGINT) AS total, count / sum(count) OVER (PARTITION BY m) AS pct
FROM c
""")
def q_month_share(spark, sf_dir):
    """H2 + I1 on orders: month x status counts with the month's share."""
    orders = table(spark, sf_dir, "orders", ["o_orderdate", "o_orderstatus"])
    counts = A.count_by_month(orders, "o_orderdate", "o_orderstatus")
    out = A.add_share(counts, "o_orderdate")
    return out.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("month"), "o_orderstatus", "count", "total",
                      "pct")


@register("share_by_group", """
WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS count FROM orders GROUP BY ALL)
SELECT o_orderpriority, o_orderstatus, count,
       CAST(sum(count) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total,
       count / sum(count) OVER (PARTITION BY o_orderpriority) AS pct
FROM c
""")
def q_share_by_group(spark, sf_dir):
    """I1 on orders: priority x status counts with the priority's share."""
    orders = table(spark, sf_dir, "orders", ["o_orderpriority", "o_orderstatus"])
    return A.add_share(A.count_by(orders, "o_orderpriority", "o_orderstatus"), "o_orderpriority")


@register("dashboard_series", f"""
WITH s AS ({SCORED_SQL}),
c AS (SELECT strftime(date, '%Y-%m') AS date, sentiment, count(*) AS count FROM s
      WHERE sentiment IS NOT NULL GROUP BY ALL)
SELECT date, sentiment, count, CAST(sum(count) OVER (PARTITION BY date) AS BIGINT) AS total,
       round(count / sum(count) OVER (PARTITION BY date), 10) AS pct
FROM c
""")
def q_dashboard_series(spark, sf_dir):
    """K8: the dashboard's monthly series (``yyyy-MM`` labels, 10-digit pct)."""
    s = scored_articles(spark, sf_dir).withColumn("date", D.month_label("date"))
    out = A.add_share(A.count_by(s, "date", "sentiment"), "date")
    return out.withColumn("pct", D.share10("pct"))


@register("sentiment_series", f"""
WITH s AS ({SCORED_SQL}),
c AS (SELECT strftime(date, '%Y-%m') AS date, sentiment, count(*) AS count FROM s
      WHERE sentiment IS NOT NULL GROUP BY ALL),
p AS (SELECT date, sentiment, round(round(count / sum(count) OVER (PARTITION BY date), 10) * 100, 1) AS pct FROM c)
SELECT date,
  max(CASE WHEN sentiment = 'negative' THEN pct END) AS negative,
  max(CASE WHEN sentiment = 'neutral' THEN pct END) AS neutral,
  max(CASE WHEN sentiment = 'positive' THEN pct END) AS positive
FROM p GROUP BY date
""")
def q_sentiment_series(spark, sf_dir):
    """One row per month, one percent column per sentiment (missing -> null)."""
    s = q_dashboard_series(spark, sf_dir)
    return s.groupBy("date").pivot("sentiment", SENTIMENTS).agg(F.first(D.pct1("pct")))


@register("label_balance", """
SELECT CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < 'd' THEN 'train'
            WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) = 'd' THEN 'validation' ELSE 'test' END AS split,
       CAST(CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 ELSE 1 END AS BIGINT) AS label,
       count(*) AS count
FROM labels GROUP BY ALL
""")
def q_label_balance(spark, sf_dir):
    """Labelled rows per (split, label)."""
    from ..operators.sentiment import labelled_examples

    ex = labelled_examples(spark, sf_dir, with_text=False)
    return A.count_by(ex, "split", "label")
