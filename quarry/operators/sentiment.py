"""Sentiment classifier training, scoring and evaluation.

The fine-tuned transformer of the analysed workflow is re-aimed as a Spark ML
pipeline (tokenise -> hashed term frequencies -> IDF -> multinomial logistic
regression): distributed fit, model selection on the validation split by
weighted F1, save / load, and batch scoring.  External models plug in through
``score_with`` (``mapInPandas``; the model is built once per task).
"""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions import lexicon as L
from ..functions.text import PY_WORD, left, null_to_empty
from ..sources.readers import read_training, table

LABEL_OF = {v: k for k, v in L.ID2LABEL.items()}


def label_name(c) -> F.Column:
    """Label id -> name."""
    m = F.create_map(*[x for k, v in sorted(L.ID2LABEL.items()) for x in (F.lit(k), F.lit(v))])
    return m[F.col(c) if isinstance(c, str) else c]


def labelled_examples(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """A3 on the fixtures: documents ⋈ labels -> (doc_id, text, label, split).

    label: 0 negative (toxic), 2 positive (quality, not toxic), 1 neutral.
    """
    labels = read_training(spark, f"{sf_dir.rstrip('/')}/labels.parquet", "doc_id")
    ex = labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1).alias("label"),
        "split",
    )
    if with_text:
        docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
        ex = ex.join(docs, "doc_id")
    return ex


def featurizer(num_features: int = 1 << 16) -> Pipeline:
    """Tokenise (Python-\\w words, lower-cased) -> hashed TF -> IDF."""
    tok = RegexTokenizer(inputCol="_input", outputCol="_tokens", pattern=PY_WORD + "+", gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    return Pipeline(stages=[tok, tf, idf])


def classifier(reg: float = 0.01, max_iter: int = 30) -> LogisticRegression:
    return LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial", regParam=reg,
                              maxIter=max_iter)


def model_input(df: DataFrame, text_col: str = "text", max_chars: int = L.SENTIMENT_MAX_CHARS) -> DataFrame:
    """Text seen by the model: first ``max_chars`` characters, null -> ''."""
    return df.withColumn("_input", left(null_to_empty(text_col), max_chars))


def train_classifier(df: DataFrame, regs: Sequence[float] = (0.0, 0.01, 0.1), text_col: str = "text",
                     seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """G4 + G6: fit one classifier per regularisation on ``split='train'``,
    keep the best weighted F1 on ``split='validation'``.

    The featurizer is fitted once; the featurized training split is persisted
    so the candidate fits share it.  Returns (best model, metrics table).
    """
    data = model_input(df, text_col)
    feats = featurizer().fit(data.filter(F.col("split") == "train"))
    train = feats.transform(data.filter(F.col("split") == "train")).select("_features", "label").persist()
    valid = feats.transform(data.filter(F.col("split") == "validation")).select("_features", "label").persist()
    best, best_f1, rows = None, -1.0, []
    try:
        for reg in regs:
            lr = classifier(reg).fit(train)
            m = evaluate(lr.transform(valid), "label", "prediction").first()
            rows.append((float(reg), float(m["accuracy"]), float(m["f1_weighted"])))
            if m["f1_weighted"] > best_f1:
                best, best_f1 = lr, m["f1_weighted"]
    finally:
        train.unpersist()
        valid.unpersist()
    model = PipelineModel(stages=list(feats.stages) + [best])
    metrics = df.sparkSession.createDataFrame(rows, "reg double, accuracy double, f1_weighted double")
    return model, metrics


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and weighted F1 from confusion counts (one aggregate).

    Per class c: precision = tp / predicted(c), recall = tp / actual(c),
    f1 = 2pr / (p + r) (0 when undefined); weighted by actual(c).
    """
    p = pred.select(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p"))
    cm = p.groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    actual = cm.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("actual"))
    predicted = cm.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    tp = cm.filter(F.col("y") == F.col("p")).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    per = actual.join(predicted, "c", "full").join(tp, "c", "left").fillna(0, ["actual", "predicted", "tp"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0)
    per = per.withColumn("prec", prec).withColumn("rec", rec)
    f1 = F.when(F.col("prec") + F.col("rec") > 0, 2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec")))
    per = per.withColumn("f1", F.coalesce(f1, F.lit(0.0)))
    return per.agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("actual")) / F.sum("actual")).alias("f1_weighted"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    """G7."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """G7."""
    return PipelineModel.load(path)


def score_sentiment(df: DataFrame, model: PipelineModel, text_col: str = "text_clean") -> DataFrame:
    """G3 with the Spark ML model: adds ``sentiment`` and ``sentiment_score``
    (probability of the predicted class)."""
    scored = model.transform(model_input(df, text_col))
    out = scored.withColumn("sentiment", label_name(F.col("prediction").cast("int")))
    out = out.withColumn("sentiment_score", F.array_max(vector_to_array("probability")))
    drop = [c for c in out.columns if c.startswith("_") or c in ("rawPrediction", "probability", "prediction")]
    return out.drop(*drop)


def score_with(df: DataFrame, make_model: Callable[[], Callable[[list[str]], list[tuple[str, float]]]],
               text_col: str = "text_clean", max_chars: int = L.SENTIMENT_MAX_CHARS,
               batch_size: int = 64) -> DataFrame:
    """G3 hook for an external model: ``make_model()`` is called once per task
    and returns ``predict(texts) -> [(label, score), ...]``; texts are fed in
    batches of ``batch_size``.  Labels are lower-cased (C14)."""
    schema = StructType(df.schema.fields + [StructField("sentiment", StringType()),
                                            StructField("sentiment_score", DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make_model()
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str).str.slice(0, max_chars).tolist()
            out: list[tuple[str, float]] = []
            for i in range(0, len(texts), batch_size):
                out.extend(predict(texts[i:i + batch_size]))
            pdf = pdf.copy()
            pdf["sentiment"] = [str(lbl).lower() for lbl, _ in out]
            pdf["sentiment_score"] = [float(s) for _, s in out]
            yield pdf

    return df.mapInPandas(run, schema)
