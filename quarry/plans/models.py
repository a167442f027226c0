"""Stage 7-8 model queries: classifier training / scoring and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import epochs as EP
from ..operators import sentiment as SN
from ..sources.readers import table
from ..sources.writers import scratch_path
from .registry import register
from .tagging import clean_articles

CONFUSION_SQL = """
WITH p AS (SELECT CAST(quality AS DOUBLE) AS y, CAST(toxic AS DOUBLE) AS p FROM labels),
cls AS (SELECT y AS c FROM p UNION SELECT p FROM p),
per AS (
  SELECT c,
    (SELECT count(*) FROM p WHERE y = c) AS actual,
    (SELECT count(*) FROM p WHERE p = c) AS predicted,
    (SELECT count(*) FROM p WHERE y = c AND p = c) AS tp
  FROM cls
),
f AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS prec,
            CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS rec FROM per
)
SELECT round(sum(tp) / sum(actual), 6) AS accuracy,
       round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END * actual) / sum(actual), 6)
         AS f1_weighted
FROM f
"""


@register("confusion_metrics", CONFUSION_SQL)
def q_confusion_metrics(spark, sf_dir):
    """Accuracy and weighted F1 of a given prediction table
    (truth = ``quality``, prediction = ``toxic``)."""
    labels = table(spark, sf_dir, "labels", ["quality", "toxic"])
    m = SN.evaluate(labels, "quality", "toxic")
    return m.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1_weighted", 6).alias("f1_weighted"))


@register("classifier_selection", None)
def q_classifier_selection(spark, sf_dir):
    """G4 + G6: fit the text classifier for three regularisation strengths on
    the train split, report accuracy / weighted F1 on validation."""
    _, metrics = SN.train_classifier(SN.labelled_examples(spark, sf_dir))
    return metrics


@register("sentiment_scores", None)
def q_sentiment_scores(spark, sf_dir):
    """Every kept article scored with the classifier that selection keeps
    (sentiment + probability of the predicted class)."""
    model, _ = SN.train_classifier(SN.labelled_examples(spark, sf_dir))
    path = scratch_path(spark, "sentiment_model")
    SN.save_model(model, path)  # G7: the scoring job loads what training saved
    return SN.score_sentiment(clean_articles(spark, sf_dir), SN.load_model(path)).select(
        "article_id", "sentiment", "sentiment_score")


@register("epoch_training", None)
def q_epoch_training(spark, sf_dir):
    """G4 + G6 by epochs: mini-batch steps on the train split, weights, optimiser state and
    validation metrics written each epoch; one row an epoch, the best marked."""
    return EP.train_epochs(SN.labelled_examples(spark, sf_dir), scratch_path(spark, "epochs"))


@register("epoch_sentiment", None)
def q_epoch_sentiment(spark, sf_dir):
    """G3 + G7: every kept article scored with the best epoch's model, read back from its folder."""
    folder = scratch_path(spark, "epochs")
    EP.train_epochs(SN.labelled_examples(spark, sf_dir), folder)
    return EP.score_epochs(clean_articles(spark, sf_dir).select("article_id", "text_clean"),
                           EP.load_best(spark, folder)).select("article_id", "sentiment", "sentiment_score")
