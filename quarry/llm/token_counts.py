"""Token counts that follow edits.

Pre-tokens (the pattern's matches) never share a token, so a document's count
is a sum over pre-tokens.  ``index_counts`` keeps, per document, the leaves of
a segment tree: blocks of BLOCK pre-tokens with their characters and tokens.
``edit_counts`` applies edits to such a document: the tree finds the blocks
that an edit touches, with two characters of context before it (the pattern
looks no further ahead); only those blocks are split and encoded again, up to
the first block end that is a pre-token end in the new text as well, and the
sums above them are updated.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .arrow import chunks

BLOCK = 32
CONTEXT = 2           # characters behind a match that may decide where it ends
CACHE = 500_000       # pre-tokens whose count a worker remembers

# The pattern of the byte-level vocabulary; letters {L}, numbers
# {N} and white space {S} stand for Unicode classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"

# Redactions of the registered query: e-mail addresses, card- and phone-like
# numbers, keys.
REDACTIONS = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>"),
    (r"\+?\d[\d ().-]{6,}\d", "<number>"),
    (r"\b[A-Za-z0-9_-]{32,}\b", "<key>"),
]


@lru_cache(maxsize=1)
def splitter() -> re.Pattern:
    """The pattern with each class written out as ranges (the standard
    module is several times as fast on those as a module that knows classes)."""
    def ranges(name: str) -> str:
        points = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
        spans = [(m.start(), m.end() - 1) for m in regex.finditer(rf"{name}+", points)]
        return "".join(rf"\U{ord(points[a]):08x}-\U{ord(points[b]):08x}" for a, b in spans)

    classes = {"L": ranges(r"\p{L}"), "N": ranges(r"\p{N}"), "S": ranges(r"\s")}
    return re.compile(re.sub(r"\{([LNS])\}", lambda m: classes[m[1]], PATTERN))


class Counter:
    """Tokens of a pre-token, remembered."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=table, special_tokens={})
        self.known: dict[str, int] = {}

    def counts(self, pre_tokens: list[str]) -> list[int]:
        known = self.known
        missing = {p for p in pre_tokens if p not in known}
        if len(known) + len(missing) > CACHE:
            known.clear()
            missing = set(pre_tokens)
        for p in missing:
            known[p] = len(self.encoding.encode_ordinary(p))
        return [known[p] for p in pre_tokens]


class CountTree:
    """Sums of characters and tokens over the blocks of one text."""

    def __init__(self, text: str, chars: list[int], tokens: list[int]):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.blocks = len(chars)
        starts = list(accumulate(chars, initial=0))
        self.texts: list = [(text, a, b) for a, b in zip(starts, starts[1:], strict=False)]  # sliced when needed
        pad = [0] * (self.size - len(chars))
        self.chars, self.tokens = [0] * self.size + chars + pad, [0] * self.size + tokens + pad
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.encoded = 0  # pre-tokens encoded again

    def text(self, block: int) -> str:
        whole, a, b = self.texts[block]
        return whole[a:b]

    def _find(self, at: int) -> tuple[int, int]:
        """(block, characters before it) of a character; the last block that
        has any for the end of the text."""
        i, before = 1, 0
        at = max(0, min(at, self.chars[1] - 1))
        while i < self.size:
            i *= 2
            if before + self.chars[i] <= at:
                before += self.chars[i]
                i += 1
        return i - self.size, before

    def _set(self, block: int, text: str, tokens: int) -> None:
        self.texts[block] = (text, 0, len(text))
        i = block + self.size
        self.chars[i], self.tokens[i] = len(text), tokens
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, start: int, stop: int, insert: str, counter: Counter) -> None:
        """Replace characters start..stop of the text as it is now."""
        first, before = self._find(start - CONTEXT)
        last, _ = self._find(stop)
        window = "".join([self.text(b) for b in range(first, last + 1)])
        window = window[:start - before] + insert + window[stop - before:]
        while True:
            ahead, b = "", last + 1
            while b < self.blocks and len(ahead) < CONTEXT:
                ahead += self.text(b)
                b += 1
            ends = [m.end() for m in splitter().finditer(window + ahead)]
            if not ahead or len(window) in ends or not window:
                break
            last = b - 1
            window += ahead
        ends = [e for e in ends if e <= len(window)]
        found = [window[a:e] for a, e in zip([0, *ends], ends, strict=False)]
        self.encoded += len(found)
        for b in range(first + 1, last + 1):
            self._set(b, "", 0)
        self._set(first, window, sum(counter.counts(found)))

    def joined(self) -> str:
        return "".join([self.text(b) for b in range(self.blocks)])


def leaves(pre_tokens: list[str], counts: list[int]) -> tuple[list[int], list[int]]:
    """Characters and tokens of each block."""
    chars = [len(p) for p in pre_tokens]
    return ([sum(chars[i:i + BLOCK]) for i in range(0, len(chars), BLOCK)],
            [sum(counts[i:i + BLOCK]) for i in range(0, len(chars), BLOCK)])


def redaction_edits(text: str, patterns: Iterable[tuple[re.Pattern, str]]) -> list[tuple[int, int, str]]:
    """Non-overlapping (start, stop, insert), the earlier pattern first."""
    taken: list[tuple[int, int, str]] = []
    for pattern, insert in patterns:
        spans = sorted((a, b) for a, b, _ in taken)
        starts = [a for a, _ in spans]
        for m in pattern.finditer(text):
            k = int(np.searchsorted(starts, m.end()))  # the spans that begin before its end
            if k == 0 or spans[k - 1][1] <= m.start():
                taken.append((m.start(), m.end(), insert))
    return sorted(taken)


_COUNTERS: dict[int, Counter] = {}


def _counter(ranks: bytes) -> Counter:
    key = hash(ranks)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(ranks)
    return _COUNTERS[key]


def index_counts(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, n_tokens, n_pretokens,
    leaf_chars, leaf_tokens`` - the count and the leaves of its segment tree.

    Null and empty texts have no leaves and 0 tokens (null stays null).  Whole
    texts are counted, special tokens as ordinary text.  Repeated rows are
    indexed each; an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    id_field = docs.select(F.col(f"`{id_col}`").alias("doc_id")).schema.fields[0]
    ints = ArrayType(IntegerType())
    schema = StructType([id_field, StructField("text", StringType()), StructField("n_tokens", LongType()),
                         StructField("n_pretokens", LongType()), StructField("leaf_chars", ints), StructField("leaf_tokens", ints)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, split = _counter(ranks), splitter()
        for batch in chunks(batches, "text"):
            sums, sizes, chars, tokens = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = split.findall(text) if text else []
                counts = counter.counts(found)
                c, t = leaves(found, counts)
                sums.append(sum(counts))
                sizes.append(len(found))
                chars.append(c)
                tokens.append(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(sums, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))], names=schema.names)

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def edit_counts(indexed: DataFrame, ranks: bytes, redactions: list[tuple[str, str]] | None = None,
                edits_col: str | None = None) -> DataFrame:
    """Rows of ``index_counts`` after edits: ``doc_id, edited, n_tokens,
    n_tokens_edited, n_pretokens, n_edits, n_reencoded``.

    Edits are the matches of ``redactions`` (pattern, replacement), or come in
    ``edits_col``, an ``array<struct<start int, stop int, insert string>>`` of
    non-overlapping places in the original text.  ``n_reencoded`` counts the
    pre-tokens that were encoded again.
    """
    schema = StructType([indexed.schema["doc_id"], StructField("edited", StringType()),
                         *(StructField(c, LongType()) for c in ("n_tokens", "n_tokens_edited", "n_pretokens", "n_edits", "n_reencoded"))])
    columns = ["doc_id", "text", "n_tokens", "n_pretokens", "leaf_chars", "leaf_tokens", *([edits_col] if edits_col else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks)
        patterns = [(re.compile(p), insert) for p, insert in redactions or []]
        for batch in chunks(batches, "text"):
            data = batch.to_pydict()
            out: list[list] = [[], [], [], []]
            for i, text in enumerate(data["text"]):
                if edits_col:
                    edits = sorted((e["start"], e["stop"], e["insert"] or "") for e in data[edits_col][i] or [])
                else:
                    edits = redaction_edits(text or "", patterns)
                if not edits:
                    row = (text, data["n_tokens"][i], 0, 0)
                else:
                    tree = CountTree(text or "", data["leaf_chars"][i] or [0], data["leaf_tokens"][i] or [0])
                    for start, stop, insert in reversed(edits):
                        tree.edit(start, stop, insert, counter)
                    row = (tree.joined(), tree.tokens[1], len(edits), tree.encoded)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.string()), batch.column("n_tokens"), pa.array(out[1], pa.int64()),
                 batch.column("n_pretokens"), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], names=schema.names)

    return indexed.select(*columns).mapInArrow(run, schema)
