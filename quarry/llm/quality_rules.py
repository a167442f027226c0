"""Quality rules with thresholds that follow each language and source.

A document is measured by four whole numbers: symbols and repeated words per
mille, repeated lines per mille, and the mean word length.  The measures of all
documents that pass the fixed base rules go into quantile sketches, one for each
(language, source, measure).  A document is kept if all its measures lie within
the fences that its own language and source set, joined back to it.

The sketch is a histogram of log-linear buckets: values below 64 are exact, larger
ones keep their first six bits, so a quantile is at most 1/32 too low.  Sketches
merge by adding counts: tasks merge their rows before the shuffle, the sketch
of a language is the merged sketch of its sources, and sketches of earlier
loads can be added (:func:`merge_sketches`).  A group has at most 32 buckets a
measure for each doubling of its values.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import materialize

MIN_WORDS = 10          # base rules: fixed
MAX_REPEATED = 20       # percent of words in repeated windows
WINDOW = 5              # words of a window
FENCE = 3               # quartile distances beyond the quartile
PRIOR = 20              # documents that the language's quantiles count for in a source's
#: Measure -> (room beyond the fence, whether low values fail too).
MEASURES = {"symbols": (40, False), "dup_lines": (80, False), "repeats": (100, False), "word_length": (100, True)}

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _window_starts(items: Column) -> Column:
    return F.sequence(F.lit(0), F.size(items) - WINDOW)


def _window(items: Column, i: Column) -> list[Column]:
    return [F.get(items, i + k) for k in range(WINDOW)]


def _repeated_words(words: Column) -> Column:
    """Words that lie in windows found twice or more (windows compared as text)."""
    def covered(ordered: Column) -> Column:
        window = lambda i: F.get(ordered, i)["w"]
        twice = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i:
                         window(i).eqNullSafe(window(i - 1)) | window(i).eqNullSafe(window(i + 1)))
        places = F.sort_array(F.transform(twice, lambda i: F.get(ordered, i)["i"]))
        # least() skips the null after the last place
        return _bound(places, lambda p: F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1), F.lit(0),
            lambda acc, k: acc + F.least(F.lit(WINDOW), F.get(p, k + 1) - F.get(p, k))))

    return _bound(F.sort_array(F.transform(
        _window_starts(words), lambda i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("w"), i.alias("i")))), covered)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source``, the counts ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words``, ``base_failed``, and the four measures."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"),
                       F.col(f"`{source_col}`").alias("source"), text.alias("text"))
    split = rows.select(
        "*", F.array_remove(F.split("text", _SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    split = split.withColumn("coded", F.transform("words", lambda w: F.xxhash64(w)))
    # equal windows have equal hashes, so distinct hashes rule repeats out; only
    # texts with an equal hash are looked at word for word
    hashes = F.when(F.size("coded") >= WINDOW, _bound(F.col("coded"), lambda c: F.transform(
        _window_starts(c), lambda i: F.xxhash64(*_window(c, i))))).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "doc_id", "lang", "source", "words", F.size("words").cast("long").alias("n_words"),
        F.length(_without(F.col("text"), _SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), _SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), hashes.alias("hashes"))
    repeats = F.when(F.size(F.array_distinct("hashes")) == F.size("hashes"), F.lit(0)).otherwise(_bound(F.col("words"), _repeated_words))
    out = counted.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                         repeats.cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    # constants below the line: a short text needs more than one hit
    return out.select(
        "*", failed.alias("base_failed"),
        F.expr("1000 * n_symbols div (word_chars + 50)").alias("symbols"),
        F.expr("1000 * n_dup_lines div (n_lines + 5)").alias("dup_lines"),
        F.expr("1000 * n_repeat_words div (n_words + 20)").alias("repeats"),
        F.expr("100 * word_chars div greatest(n_words, 1)").alias("word_length")).drop("n_lines")


def bucket_of(value: Column) -> Column:
    """Least value of the sketch bucket that holds a whole number >= 0."""
    step = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, step), step)


def quantile_sketch(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """``keys..., measure, bucket, n``: the mergeable sketches of whole-number
    columns, one for each combination of the keys (null is a value of its own)."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), bucket_of(F.col(m)).alias("bucket")) for m in measures])
    return rows.select(*keys, F.inline(cells)).groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches (of several loads, or of finer keys) merged over ``keys``."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., measure, n, q1, q3`` of each sketch: the least buckets that a
    quarter and three quarters of the rows reach."""
    own = Window.partitionBy(*keys, "measure")
    upto = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.select("*", F.sum("n").over(upto).alias("_upto"), F.sum("n").over(own).alias("_all"))
    at = lambda k: F.min(F.when(4 * F.col("_upto") >= k * F.col("_all"), F.col("bucket")))
    return ranked.groupBy(*keys, "measure").agg(F.max("_all").alias("n"), at(1).alias("q1"), at(3).alias("q3"))


def fences(sketch: DataFrame, prior: int = PRIOR, fence: int = FENCE, rooms: dict = MEASURES) -> DataFrame:
    """``lang, source`` and ``<measure>_low, <measure>_high`` of each group.

    A source's quartiles are drawn towards its language's as if the language
    added ``prior`` documents, so a source of few documents sets no fence alone.
    """
    groups = quartiles(sketch, ["lang", "source"])
    whole = quartiles(merge_sketches(sketch, ["lang"]), ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("measure").alias("_measure"), F.col("q1").alias("_q1"), F.col("q3").alias("_q3"))
    both = groups.join(whole, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure")))
    drawn = lambda q: F.expr(f"(n * {q} + {prior} * _{q}) div (n + {prior})")
    both = both.select("lang", "source", "measure", drawn("q1").alias("q1"), drawn("q3").alias("q3"))
    limits = []
    for m, (room, two_sided) in rooms.items():
        own = lambda c, m=m: F.max(F.when(F.col("measure") == m, c))
        spread = fence * (F.col("q3") - F.col("q1")) + room
        limits.append(own(F.col("q3") + spread).alias(f"{m}_high"))
        limits.append(own(F.col("q1") - spread if two_sided else F.lit(0)).alias(f"{m}_low"))
    return both.groupBy("lang", "source").agg(*limits)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", earlier: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, reasons``.

    ``reasons`` joins ``base`` and the measures beyond their fences by commas, empty
    for kept documents.  ``earlier`` adds sketches of earlier loads
    (:func:`quantile_sketch` over lang and source).

    Null, empty and blank texts have no words and fail the base rules.  Null
    languages and sources are groups of their own.  Repeated rows count and are
    judged each; an empty table gives an empty result; other columns are ignored,
    whatever their names.
    """
    keys = ["lang", "source"]
    rows = materialize(measure(docs, id_col, text_col, lang_col, source_col), "quality_measures")
    sketch = quantile_sketch(rows.filter(~F.col("base_failed")), keys, list(MEASURES))
    if earlier is not None:
        sketch = merge_sketches(sketch.unionByName(earlier.select(*sketch.columns)), keys)
    limits = fences(materialize(sketch, "quality_sketches"))
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    judged = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    beyond = [F.when((F.col(m) > F.col(f"{m}_high")) | (F.col(m) < F.col(f"{m}_low")), m) for m in MEASURES]
    reasons = F.when(F.col("base_failed"), "base").otherwise(F.concat_ws(",", *beyond))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (reasons == "").alias("kept"), reasons.alias("reasons"))
