"""Scalar text functions as Spark ``Column`` expressions.

All work stays in the JVM (whole-stage codegen) except NFKC, which Spark has no
built-in for and which runs as an Arrow-batched ``pandas_udf``.

Regular expressions follow Python ``str`` semantics, which the corpus rules
were written against: Python's ``\\s`` is wider than Java's ``(?U)\\s`` (it also
covers U+001C..U+001F) and its ``\\w`` is letters, numbers and underscore.  The
explicit classes below are valid in both Java and RE2, so the DuckDB oracle can
use the very same strings.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import lexicon as L

# Python's whitespace set: ASCII controls, U+001C..U+001F, NEL and Unicode Z*.
PY_SPACE = r"[\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]"
# Python's word character set for ``str`` patterns.
PY_WORD = r"[\p{L}\p{N}_]"
PY_NONWORD = r"[^\p{L}\p{N}_]"
# Python's ``\d`` for ``str`` patterns.
PY_DIGIT = r"\p{Nd}"
# Characters kept by the company normaliser (word or whitespace).
_NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]"

# Java forms of the light-clean patterns in ``lexicon`` (same meaning as the
# Python originals on ``str``; ``(?U)`` makes ``\b`` Unicode-aware).
_SEP = r"[\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}.-]"
EMAIL_RE = "(?U)" + L.EMAIL_PATTERN
PHONE_RE = (
    rf"(\+?{PY_DIGIT}{{1,2}}{_SEP}?)?(\(?{PY_DIGIT}{{3}}\)?{_SEP}?){PY_DIGIT}{{3}}{_SEP}?{PY_DIGIT}{{4}}"
)


def _py_space_pattern(snippet: str) -> str:
    """Swap Python's ``\\s`` in a fixed snippet for the explicit class."""
    return snippet.replace(r"\s", PY_SPACE)


BOILERPLATE_RE = "(?iu)" + "|".join(_py_space_pattern(s) for s in L.BOILERPLATE_SNIPPETS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_to_empty(c) -> Column:
    """Null -> ''."""
    return F.coalesce(_c(c), F.lit(""))


def collapse_ws(c) -> Column:
    """Collapse runs of (Python) whitespace to one space and strip the ends."""
    return F.trim(F.regexp_replace(_c(c), PY_SPACE + "+", " "))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """NFKC normalisation; ASCII rows are returned untouched (NFKC-stable)."""
    def one(x):
        if x is None or x.isascii():
            return x
        return unicodedata.normalize("NFKC", x)
    return s.map(one)


def is_ascii(c) -> Column:
    """True when every character is ASCII (UTF-8 bytes == characters)."""
    x = _c(c)
    return F.octet_length(x) == F.length(x)


def normalize_text(c, unicode_nfkc: bool = True) -> Column:
    """NFKC, drop NUL, CR -> LF, collapse whitespace, strip.  Null -> ''.

    Only non-ASCII texts are shipped to the NFKC worker (ASCII is NFKC-stable);
    ASCII rows cross the Arrow boundary as nulls.
    """
    x = null_to_empty(c)
    if unicode_nfkc:
        x = F.coalesce(nfkc(F.when(~is_ascii(x), x)), x)
    return collapse_ws(_line_ends(x))


def strip_emails(c) -> Column:
    """E-mail addresses -> one space (only texts containing '@' are scanned)."""
    x = _c(c)
    return F.when(F.instr(x, "@") > 0, F.regexp_replace(x, EMAIL_RE, " ")).otherwise(x)


# How every phone number in an ASCII text ends.
_PHONE_END_RE = r"[0-9]{3}[\t\n\x0b\f\r\x1c-\x20.-]?[0-9]{4}"


def _no_phone_end(x: Column) -> Column:
    """ASCII text in which no phone number can end (then none stands in it)."""
    return is_ascii(x) & ~x.rlike(_PHONE_END_RE)


def strip_phones(c) -> Column:
    """Phone numbers (any 10-digit run qualifies) -> one space.

    ASCII texts without the last seven digits of one cannot match and skip the scan.
    """
    x = _c(c)
    return F.when(_no_phone_end(x), x).otherwise(F.regexp_replace(x, PHONE_RE, " "))


# Every boilerplate snippet needs one of these words (any case); in ASCII text
# a snippet can only match where its word occurs.
_BOILER_ANCHORS = ("newsletter", "policy", "service", "reserved", "advertisement")


def _may_hold_boilerplate(x: Column) -> Column:
    low = F.lower(x)
    hit = low.contains("read") & low.contains("more")
    for w in _BOILER_ANCHORS:
        hit = hit | low.contains(w)
    return ~is_ascii(x) | hit


def strip_boilerplate(c, snippets: list[str] | None = None) -> Column:
    """C4: boilerplate phrases, case-blind -> one space."""
    x = _c(c)
    if snippets is not None:
        return F.regexp_replace(x, "(?iu)" + "|".join(_py_space_pattern(s) for s in snippets), " ")
    return F.when(_may_hold_boilerplate(x), F.regexp_replace(x, BOILERPLATE_RE, " ")).otherwise(x)


def light_clean(c) -> Column:
    """E-mails, then phones, then boilerplate, then whitespace; null -> ''."""
    return collapse_ws(strip_boilerplate(strip_phones(strip_emails(null_to_empty(c)))))


def with_steps(df: DataFrame, src: str, out: str, steps) -> DataFrame:
    """``out`` = the steps applied to ``src``, one projection a step.

    Each step reads its input several times.  As a column that is read by name
    the input is computed once; nested expressions would multiply.
    """
    df = df.withColumn(out, null_to_empty(src))
    for step in steps:
        df = df.withColumn(out, step(F.col(out)))
    return df


def _to_nfkc(x: Column) -> Column:
    return F.coalesce(nfkc(F.when(~is_ascii(x), x)), x)


def _line_ends(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\x00"), F.lit("")), F.lit("\r"), F.lit("\n"))


NORMALIZE_STEPS = (_to_nfkc, _line_ends, collapse_ws)
LIGHT_CLEAN_STEPS = (strip_emails, strip_phones, strip_boilerplate, collapse_ws)


def with_clean(df: DataFrame, src: str, out: str) -> DataFrame:
    """C1 then C5 as a column ``out`` of the frame."""
    return with_steps(df, src, out, NORMALIZE_STEPS + LIGHT_CLEAN_STEPS)


def left(c, n: int) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_c(c), 1, n)


def embed_input(title, text, max_chars: int = L.EMBED_MAX_CHARS) -> Column:
    """``(title + " " + text[:n]).strip()``."""
    return F.trim(F.concat(null_to_empty(title), F.lit(" "), left(null_to_empty(text), max_chars)))


def entity_input(title, text, max_chars: int = L.ENTITY_MAX_CHARS) -> Column:
    """``(title + ". " + text)[:n]``."""
    return left(F.concat(null_to_empty(title), F.lit(". "), null_to_empty(text)), max_chars)


PY_NONSPACE_RUN = r"[^\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]+"


def words(c) -> Column:
    """``str.split()``: the runs of non-whitespace characters.

    A plain regex extraction (no lambda), so it stays in generated code even
    when its input is a long expression such as the cleaning chain.
    """
    return F.regexp_extract_all(null_to_empty(c), F.lit(PY_NONSPACE_RUN), 0)


def topic_text(title, text, max_words: int = L.TOPIC_MAX_WORDS) -> Column:
    """Title + ". " + first ``max_words`` words of the text."""
    head = F.array_join(F.slice(words(text), 1, max_words), " ")
    return F.concat(null_to_empty(title), F.lit(". "), head)


def clean_span(c, strip_chars: str = L.SPAN_STRIP_CHARS) -> Column:
    """Collapse whitespace in an entity span, strip punctuation ends."""
    squeezed = F.regexp_replace(_c(c), PY_SPACE + "+", " ")
    return F.btrim(squeezed, F.lit(strip_chars))


def title_case(c) -> Column:
    """``str.title()``: upper-case the first cased letter after an uncased one.

    Spark's ``initcap`` only capitalises after spaces ("3m" stays "3m"), so the
    string is cut into runs of cased letters and other characters and each
    letter run is capitalised.
    """
    runs = F.regexp_extract_all(_c(c), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def normalize_company(c, suffixes: list[str] | None = None) -> Column:
    """Punctuation -> space, lower, drop suffix words, title-case."""
    suffixes = L.CORP_SUFFIXES if suffixes is None else suffixes
    lowered = F.lower(F.regexp_replace(_c(c), _NOT_WORD_OR_SPACE, " "))
    kept = F.filter(words(lowered), lambda w: ~w.isin(suffixes))
    return F.trim(title_case(F.array_join(kept, " ")))


def safe_label(c) -> Column:
    """Label usable in a file name: drop characters that are neither
    word, whitespace nor hyphen, then spaces -> underscores."""
    kept = F.regexp_replace(_c(c), r"[^\p{L}\p{N}_\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}-]", "")
    return F.regexp_replace(kept, " ", "_")


def tokens(c) -> Column:
    """Lower-cased words of two or more word characters (vectoriser default)."""
    return F.regexp_extract_all(F.lower(null_to_empty(c)), F.lit(PY_WORD + "{2,}"), 0)


def ngrams(tok: Column, n_max: int = 2) -> Column:
    """1- to ``n_max``-grams of a token array (grams joined by one space).

    Each order k zips the (k-1)-grams with the tokens shifted by k-1; the
    padding nulls at the tail are filtered.  ``tok`` should be a column
    reference: it is read a fixed number of times, never once per element.
    """
    out = tok
    prev = tok
    for k in range(2, n_max + 1):
        shifted = F.slice(tok, k, F.greatest(F.size(tok) - (k - 1), F.lit(0)))
        prev = F.zip_with(prev, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, F.filter(prev, lambda g: g.isNotNull()))
    return out


def excerpt(c, n: int, suffix: str = L.EXCERPT_SUFFIX) -> Column:
    """First ``n`` characters plus a suffix."""
    return F.concat(left(c, n), F.lit(suffix))


def head_of_list(c, n: int = L.DASHBOARD_KEYWORDS) -> Column:
    """C17: first ``n`` items of a comma list, trimmed, re-joined with ", "."""
    return F.array_join(F.transform(F.slice(F.split(_c(c), ","), 1, n), lambda x: F.trim(x)), ", ")


def thousands(c) -> Column:
    """Integer with thousands separators."""
    return F.format_number(_c(c), 0)
