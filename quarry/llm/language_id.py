"""Language ID by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of its
labelled text.  A text is parsed against it: the longest match from the
current place is one phrase, then the parse starts again behind it.  The fewer
phrases a language needs per character, the better it explains the text; the
fewest win.  A phrase counts as log2 of a full sample's length in bits, for all
languages alike: one with little text gains nothing by cheap phrases.

Parsing is vectorised: texts are cut in segments of SEGMENT letters (a phrase
ends at a cut, for all languages alike) and all segments of a chunk advance
together, one character per step, in all automata.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .arrow import chunks

SEGMENT = 256
# Bounds on the labelled sample of each language: characters read of each
# document, and characters kept in all.
SAMPLE_DOC_CHARS, SAMPLE_CHARS = 2000, 20_000
UNKNOWN = "und"
# A language's bound on bits a character: see bounds() and _excess().
QUANTILE, MARGIN, MIN_HELD, SLACK = 0.99, 2.0, 20, 4


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case."""
    is_letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            is_letter[c] = True
            lower[c] = ord(ch.lower()[0])
    return is_letter, lower


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def squeeze(text: str) -> str:
    """Lower-cased letters; every run of other characters is one space."""
    is_letter, lower = letters()
    p = code_points(text)
    p = np.where(is_letter[p], lower[p], 32)
    keep = np.ones(len(p), bool)
    keep[1:] = (p[1:] != 32) | (p[:-1] != 32)
    return "".join(map(chr, p[keep].tolist()))


def suffix_automaton(s: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings of ``s``."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in s:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Parser:
    """All languages' automata in one table.

    ``table[state * width + code]`` is ``2 * next state * width``, plus 1 where
    a new phrase begins.  Code 0 is a space, 1.. the sample's letters, then one
    code for all other letters (a phrase of its own) and one that pads.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        alphabet = sorted({c for s in samples.values() for c in s} - {" "})
        code = {" ": 0} | {c: i + 1 for i, c in enumerate(alphabet)}
        self.other, self.pad = len(alphabet) + 1, len(alphabet) + 2
        self.width = width = len(alphabet) + 3
        self.alphabet = np.array([ord(c) for c in alphabet], np.uint32)
        self.weight = np.full(len(self.languages), math.log2(SAMPLE_CHARS))
        parts, self.roots, base = [], [], 0
        for lang in self.languages:
            step = suffix_automaton([code[c] for c in samples[lang]])
            n = len(step)
            root = np.full(width, 2 * base * width + 1, np.int64)  # nothing matches: a phrase of one character
            for c, to in step[0].items():
                root[c] = 2 * (base + to) * width + 1
            t = np.tile(root, (n, 1))
            at = np.repeat(np.arange(n), [len(x) for x in step])
            to = np.fromiter((v for x in step for v in x.values()), np.int64, len(at))
            c = np.fromiter((k for x in step for k in x), np.int64, len(at))
            t[at, c] = 2 * (base + to) * width
            t[0, :] |= 1  # the first character of a segment begins a phrase
            t[:, self.pad] = 2 * (base + np.arange(n)) * width
            parts.append(t)
            self.roots.append(base * width)
            base += n
        table = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int64)
        self.table = table.astype(np.int32) if len(table) < 2**30 else table

    def lookup(self) -> np.ndarray:
        """Code of each code point."""
        is_letter, lower = letters()
        own = np.zeros(0x110000, np.uint16)
        own[is_letter] = self.other
        own[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        return np.where(is_letter, own[lower], 0).astype(np.uint16)

    def rates(self, texts: list[str], lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters per text, and weighted phrases per character: texts x languages."""
        n = len(texts)
        points = [code_points(t) for t in texts]
        sizes = np.array([len(p) for p in points])
        codes = lookup[np.concatenate(points)] if sizes.sum() else np.zeros(0, np.uint16)
        doc = np.repeat(np.arange(n), sizes)
        first = np.zeros(len(codes), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        keep = codes != 0
        n_letters = np.bincount(doc[keep], minlength=n)
        keep[1:] |= (codes[:-1] != 0) & ~first[1:]  # the first of a run of spaces stays, inside a text
        codes, doc = codes[keep], doc[keep]
        sizes = np.bincount(doc, minlength=n)
        # segments: (text, start, length), longest first
        per_doc = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(n), per_doc)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        start = (np.cumsum(sizes) - sizes)[owner] + rank * SEGMENT
        length = np.minimum(sizes[owner] - rank * SEGMENT, SEGMENT)
        padded = np.concatenate([codes, np.full(SEGMENT, self.pad, np.uint16)])
        grid = padded[start[:, None] + np.arange(SEGMENT)]
        grid[np.arange(SEGMENT) >= length[:, None]] = self.pad
        steps = np.ascontiguousarray(grid.T.astype(np.int32))
        phrases = np.zeros((len(self.languages), n))
        for k, root in enumerate(self.roots):
            state = np.full(len(owner), root, self.table.dtype)
            count = np.zeros(len(owner), np.int32)
            for row in steps:
                got = self.table[state + row]
                count += got & 1
                state = got >> 1
            phrases[k] = np.bincount(owner, weights=count, minlength=n)
        return n_letters, (phrases * self.weight[:, None] / np.maximum(sizes, 1)).T


def bucket(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5 (null id: null)."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))


def _first_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``lang, h, text``: each language's distinct texts, the least
    hashes first, until they fill SAMPLE_CHARS."""
    found: dict[str, dict[str, str]] = {}
    last: dict[str, str] = {}  # the hash that fills a language's sample
    for batch in batches:
        for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text")), strict=True):
            own = found.setdefault(lang, {})
            if h in own or h > last.get(lang, h):
                continue
            text = squeeze(text).strip()
            if text:
                own[h] = text
        for lang, own in found.items():
            size = 0
            for h in sorted(own):
                if size >= SAMPLE_CHARS:
                    del own[h]
                    continue
                size += len(own[h]) + 1
                if size >= SAMPLE_CHARS:
                    last[lang] = h
    rows = [(lang, h, text) for lang, own in found.items() for h, text in own.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["lang", "h", "text"])


def language_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Sample of each label from the rows that may be learned from: distinct
    texts in the order of their hash, SAMPLE_DOC_CHARS characters each, until
    they fill SAMPLE_CHARS."""
    text = F.col(f"`{text_col}`")
    rows = docs.filter((bucket(F.col(f"`{id_col}`")) != 0) & F.col(f"`{lang_col}`").isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.md5(text.cast("binary")).alias("h"),
        F.substring(text, 1, SAMPLE_DOC_CHARS).alias("text"))
    kind = "lang string, h string, text string"
    # What is first of all is first in its task: each sends on a sample's length.
    best = rows.mapInArrow(_first_texts, kind).repartition("lang").mapInArrow(_first_texts, kind)
    found: dict[str, list] = {}
    for r in best.collect():  # SAMPLE_CHARS a language
        found.setdefault(r["lang"], []).append((r["h"], r["text"]))
    return {lang: squeeze(" ".join(t for _, t in sorted(rows)))[:SAMPLE_CHARS] for lang, rows in found.items()}


def _judge(parser: Parser, lookup: np.ndarray, texts: list) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, lead, bits per character and letters of each text."""
    n, rates = parser.rates([t or "" for t in texts], lookup)
    if not parser.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), n
    order = np.argsort(rates, axis=1, kind="stable")
    best = np.take_along_axis(rates, order[:, :1], 1)[:, 0]
    lead = np.ones(len(texts))
    if len(parser.languages) > 1:
        second = np.take_along_axis(rates, order[:, 1:2], 1)[:, 0]
        lead = np.clip(1 - best / np.where(second > 0, second, 1), 0, 1)
    langs = [parser.languages[k] if m else UNKNOWN for k, m in zip(order[:, 0], n, strict=True)]
    return langs, np.where(n > 0, lead, 0.0), np.where(n > 0, best, 0.0), n


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, lang_pred, score, bits, n_letters``.

    ``bits`` is the winner's rate: bits per character for coding the text as
    phrases of its sample.  It nears log2 of SAMPLE_CHARS (14.3) for a
    text that the language does not explain at all; 0 for ``und``.

    ``score`` is the winner's lead: 1 - its rate / the runner-up's rate, 0 at a
    tie (then the lower label wins), 1 if only one language was learned.  Null
    texts, texts without a letter, and all texts if nothing was learned, give
    ``und`` with score 0.  Whole texts are parsed.  Repeated rows are judged
    each; an empty table gives an empty result; other columns are ignored,
    whatever their names.
    """
    id_field = docs.select(F.col(f"`{id_col}`").alias("doc_id")).schema.fields[0]
    schema = StructType([id_field, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("bits", DoubleType()), StructField("n_letters", LongType())])
    parser = Parser(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = parser.lookup()
        for batch in chunks(batches, "text"):
            langs, scores, bits, n = _judge(parser, lookup, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(bits, pa.float64()), pa.array(n, pa.int64())],
                names=["doc_id", "lang_pred", "score", "bits", "n_letters"])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def _excess(bits: np.ndarray, n_letters: np.ndarray) -> np.ndarray:
    """Bits a character above what SLACK phrases cost: a short text may hold
    few words, and none of them be in the sample."""
    return bits - SLACK * math.log2(SAMPLE_CHARS) / np.maximum(n_letters, 1)


def bounds(docs: DataFrame, samples: dict[str, str], max_bits: float, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang") -> dict[str, float]:
    """For each language, the excess that its own texts keep below: MARGIN above
    the QUANTILE of the labelled texts that were held out of the samples, each
    text once; ``max_bits`` at most, and for languages with less than MIN_HELD
    such texts."""
    text = F.col(f"`{text_col}`")
    held = docs.filter((bucket(F.col(f"`{id_col}`")) == 0) & F.col(f"`{lang_col}`").isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.md5(text.cast("binary")).alias("h"), text.alias("text"))
    parser = Parser(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = parser.lookup()
        for batch in chunks(batches, "text"):
            langs, _, bits, n = _judge(parser, lookup, batch.column("text").to_pylist())
            own = pa.array([a == b for a, b in zip(langs, batch.column("lang").to_pylist(), strict=True)], pa.bool_())
            out = pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(_excess(bits, n), pa.float64())],
                                             names=["lang", "h", "excess"])
            yield out.filter(own)

    once = held.mapInArrow(run, "lang string, h string, excess double").groupBy("lang", "h").agg(F.max("excess").alias("excess"))
    found = once.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("excess", QUANTILE, 10_000).alias("q")).collect()
    return dict.fromkeys(samples, max_bits) | {r["lang"]: min(max_bits, r["q"] + MARGIN) for r in found if r["n"] >= MIN_HELD}


def keep_explained(docs: DataFrame, samples: dict[str, str], bound: dict[str, float], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a letter and in its
    best language an excess of at most that language's bound."""
    parser = Parser(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = parser.lookup()
        for batch in chunks(batches, text_col):
            langs, _, bits, n = _judge(parser, lookup, batch.column(text_col).to_pylist())
            excess = _excess(bits, n).tolist()
            yield batch.filter(pa.array([k != UNKNOWN and x <= bound[k] for k, x in zip(langs, excess, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
