"""G1 entity mentions and K1 company counts.

The default extractor is rule-based and stays in the JVM: capitalised word
runs of the model input (``title. text`` cut to 2000 characters) become
mentions; runs of two or more words are labelled ORG, single words MISC.
A user model plugs in through ``extract_with`` (``mapInPandas``, model built
once per task, one input row -> many mention rows).
"""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import lexicon as L
from ..functions.text import clean_span, entity_input, normalize_company
from .aggregates import count_by
from .filters import filter_min_length, filter_not_match

# A capitalised word, optionally followed by more capitalised words.
SPAN_PATTERN = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*"


def extract_entities(df: DataFrame, title: str = "title_clean", text: str = "text_clean",
                     keep: Sequence[str] = (), max_chars: int = L.ENTITY_MAX_CHARS) -> DataFrame:
    """G1 (rule-based) + C12 + B8: one row per mention with its position."""
    spans = F.regexp_extract_all(entity_input(title, text, max_chars), F.lit(SPAN_PATTERN), 0)
    raw = df.select(*keep, F.posexplode_outer(spans).alias("pos", "span")).filter(F.col("span").isNotNull())
    ents = raw.select(
        *keep, "pos",
        clean_span("span").alias("entity_text"),
        F.when(F.col("span").contains(" "), "ORG").otherwise("MISC").alias("entity_label"),
        F.lit(1.0).alias("score"),
    )
    return filter_min_length(ents, "entity_text", 2)


def extract_with(df: DataFrame, make_model: Callable[[], Callable[[list[str]], list[list[dict]]]],
                 title: str = "title_clean", text: str = "text_clean", keep: Sequence[str] = (),
                 max_chars: int = L.ENTITY_MAX_CHARS, batch_size: int = 32) -> DataFrame:
    """G1 hook: ``make_model()`` returns ``predict(texts) -> [[{entity_group,
    word, score}, ...], ...]``; called in batches of ``batch_size`` per task."""
    inp = df.select(*keep, entity_input(title, text, max_chars).alias("_in"))
    fields = [f for f in inp.schema.fields if f.name != "_in"]
    schema = StructType(fields + [StructField("pos", LongType()), StructField("entity_text", StringType()),
                                  StructField("entity_label", StringType()), StructField("score", DoubleType())])
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make_model()
        for pdf in batches:
            texts = pdf["_in"].fillna("").astype(str).tolist()
            out = []
            for i in range(0, len(texts), batch_size):
                out.extend(predict(texts[i:i + batch_size]))
            rows = []
            for rec, ents in zip(pdf[names].itertuples(index=False, name=None), out):
                for pos, e in enumerate(ents):
                    rows.append((*rec, pos, e["word"], e["entity_group"], float(e["score"])))
            yield pd.DataFrame(rows, columns=names + ["pos", "entity_text", "entity_label", "score"])

    mentions = inp.mapInPandas(run, schema)
    mentions = mentions.withColumn("entity_text", clean_span("entity_text"))
    return filter_min_length(mentions, "entity_text", 2)


def companies(mentions: DataFrame, label: str = "ORG") -> DataFrame:
    """B7 + C13 + B9 + B10: ORG mentions with a normalised company name."""
    orgs = mentions.filter(F.col("entity_label") == label)
    named = orgs.withColumn("company", normalize_company("entity_text"))
    named = filter_min_length(named, "company", 2, strict=True)
    return filter_not_match(named, "company", L.COMPANY_EXCLUDE_PATTERN, case_blind=True)


def company_counts(mentions: DataFrame, group: str = "industry_label") -> DataFrame:
    """K1: mentions per (industry, company), industry ascending, count descending."""
    counts = count_by(companies(mentions), group, "company")
    return counts.orderBy(F.col(group), F.col("count").desc(), F.col("company"))
