"""Dictionary tagging of text as a column expression.

``tag(text, dictionary)`` returns the sorted distinct labels whose phrase list
has at least one hit.  Two matching modes:

* ``"substring"`` (parity): ``phrase in text.lower()``; a phrase that contains
  another phrase of the same label can never change the answer and is dropped
  before the plan is built.
* ``"word"``: the phrase must sit between non-word characters (Python ``\\w``).

Two engines, both plain expressions that stay in generated code:

* ``"contains"`` (default): an OR-chain of ``contains`` over one lower-cased
  copy of the text;
* ``"rlike"``: one alternation per label.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .text import PY_WORD, null_to_empty

Dictionary = Mapping[str, Sequence[str]]


def minimal_phrases(phrases: Sequence[str]) -> list[str]:
    """Drop phrases that contain another phrase of the same list.

    In substring mode ``a in text`` implies ``b in text`` whenever ``a``
    contains ``b``, so only the shortest cover is needed.
    """
    uniq = sorted(set(p.lower() for p in phrases if p), key=lambda p: (len(p), p))
    kept: list[str] = []
    for p in uniq:
        if not any(k in p for k in kept):
            kept.append(p)
    return kept


def _word_regex(phrases: Sequence[str]) -> str:
    alt = "|".join(re.escape(p.lower()) for p in sorted(set(phrases)))
    # Java lookarounds give Python-\w boundaries without consuming text.
    return f"(?<!{PY_WORD})(?:{alt})(?!{PY_WORD})"


def label_hit(lowered: Column, phrases: Sequence[str], mode: str = "substring", engine: str = "contains") -> Column:
    """Boolean: does the lower-cased text hit any phrase of one label."""
    if not phrases:
        return F.lit(False)
    if mode == "word":
        return lowered.rlike(_word_regex(phrases))
    if mode != "substring":
        raise ValueError(f"unknown mode {mode!r}")
    if engine not in ("contains", "rlike"):
        raise ValueError(f"unknown engine {engine!r}")
    if engine == "rlike":
        return lowered.rlike("|".join(re.escape(p) for p in minimal_phrases(phrases)))
    cond = None
    for p in minimal_phrases(phrases):
        c = lowered.contains(p)
        cond = c if cond is None else (cond | c)
    return cond


def tag(text, dictionary: Dictionary, mode: str = "substring", engine: str = "contains") -> Column:
    """Sorted distinct labels of ``dictionary`` that hit ``text``."""
    t = F.col(text) if isinstance(text, str) else text
    lowered = F.lower(null_to_empty(t))
    hits = [F.when(label_hit(lowered, dictionary[label], mode, engine), F.lit(label)) for label in sorted(dictionary)]
    if not hits:
        return F.array().cast(ArrayType(StringType()))
    # labels are distinct and already sorted: removing the nulls with
    # array_except keeps the order and, unlike a lambda filter, stays in
    # whole-stage generated code
    return F.array_except(F.array(*hits), F.array(F.lit(None).cast(StringType())))
