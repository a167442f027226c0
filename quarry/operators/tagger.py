"""G1: entity spans with scores from a linear-chain tagger.

A text is cut into tokens with offsets; each token gets a tag (``O``, or ``B-`` /
``I-`` of a label) by the best path over hashed token features and tag steps.  The
weights maximise the likelihood of labelled spans: every pass, each task adds up its
own windows' share of the gradient (one row a bucket that it has met), the shares meet
by bucket, and the driver moves weights of a fixed size.

Shares are whole numbers (multiples of 1 / UNIT), so their sums do not depend on the
order in which tasks finish.

Texts are decoded whole, in windows that overlap; a token's tag and score come from the
window in which it lies farther from an edge.  A task works on about CELLS tokens at a
time, so its memory follows the longest single text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_span
from ..sources.writers import materialize
from .filters import filter_min_length

BUCKETS = 1 << 15
WINDOW = 128
OVERLAP = 32
PASSES = 20
RATE = 0.2
DECAY = 1e-5
UNIT = 1 << 32
CELLS = 1 << 16   # tokens, and
GROUP = 512       # windows, that a task works on at a time
WORDS = 1 << 16   # words whose features a task remembers

SPAN_TYPE = "array<struct<start:int,end:int,label:string>>"
_TOKEN = re.compile(r"\w+|[^\w\s]")
_OWN, _BEFORE, _AFTER = slice(0, 3), slice(3, 5), slice(5, 7)
FEATURES = 7
_EDGE = "\n"  # stands before the first and after the last token


@dataclass(frozen=True)
class Tagger:
    """``tags`` (the first is ``O``), ``weights`` (buckets x tags), ``steps`` (tag before x tag)."""

    tags: tuple[str, ...]
    weights: np.ndarray
    steps: np.ndarray

    def save(self, spark: SparkSession, folder: str) -> None:
        """Parquet: one row a bucket, one row a tag."""
        buckets = [(i, w.tolist()) for i, w in enumerate(self.weights)]
        tags = [(i, t, s.tolist()) for i, (t, s) in enumerate(zip(self.tags, self.steps, strict=True))]
        spark.createDataFrame(buckets, "bucket int, weight array<double>").write.mode("overwrite").parquet(os.path.join(folder, "buckets"))
        spark.createDataFrame(tags, "id int, tag string, step array<double>").write.mode("overwrite").parquet(os.path.join(folder, "tags"))

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Tagger:
        buckets = sorted(spark.read.parquet(os.path.join(folder, "buckets")).collect())
        tags = sorted(spark.read.parquet(os.path.join(folder, "tags")).collect())
        return Tagger(tuple(t.tag for t in tags), np.array([b.weight for b in buckets]), np.array([t.step for t in tags]))


def tag_names(labels: Sequence[str]) -> tuple[str, ...]:
    """``O``, then begin and inside of each label."""
    return ("O", *(f"{p}-{label}" for label in sorted(set(labels)) for p in "BI"))


def tokenize(text: str) -> tuple[list[str], np.ndarray]:
    """Words and single symbols with their (start, end) characters."""
    found = list(_TOKEN.finditer(text))
    return [m.group() for m in found], np.array([m.span() for m in found], np.int32).reshape(-1, 2)


def shape(word: str) -> str:
    """Capitals X, other letters x, digits 9, repeats once: ``Acme2`` -> ``Xx9``."""
    kinds = ["X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word]
    return "".join(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)


class WordFeatures:
    """Hashed features of tokens; what a word adds to itself and to its neighbours is worked out once."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.known: dict[str, list[int]] = {}

    def _of(self, word: str) -> list[int]:
        row = self.known.get(word)
        if row is None:
            low, form = word.lower(), shape(word)
            names = ("w=" + low, "s=" + form, "e=" + low[-3:], "w-" + low, "s-" + form, "w+" + low, "s+" + form)
            row = [zlib.crc32(n.encode("utf-8", "replace")) % self.buckets for n in names]
            if len(self.known) >= WORDS:
                self.known.clear()
            self.known[word] = row
        return row

    def __call__(self, words: list[str]) -> np.ndarray:
        """(tokens, FEATURES) buckets: the token's own, those of the token before and after."""
        rows = np.array([self._of(w) for w in (_EDGE, *words, _EDGE)], np.int32)
        return np.hstack([rows[1:-1, _OWN], rows[:-2, _BEFORE], rows[2:, _AFTER]])


def windows(n: int, size: int = WINDOW, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """(first, end, kept first, kept end) of each window; the kept parts tile the n tokens."""
    out = []
    for first in range(0, max(n - overlap, 1), size - overlap):
        end = min(first + size, n)
        out.append((first, end, first + overlap // 2 if first else 0, n if end == n else end - (overlap - overlap // 2)))
    return out if n else []


def _add(x: np.ndarray, axis: int) -> np.ndarray:
    """log of summed exponentials."""
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def forward_backward(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of padded windows (window, place, tag): log of all paths before and after each
    place, log of all paths, and each tag's probability."""
    b, n, _ = scores.shape
    before, after = np.array(scores), np.zeros(scores.shape)
    for t in range(1, n):
        before[:, t] += _add(before[:, t - 1, :, None] + steps, 1)
    for t in range(n - 2, -1, -1):
        onward = _add(steps + (scores[:, t + 1] + after[:, t + 1])[:, None, :], 2)
        after[:, t] = np.where((t + 1 < lengths)[:, None], onward, 0)
    total = _add(before[np.arange(b), lengths - 1], 1)
    chance = np.exp(before + after - total[:, None, None])
    chance[np.arange(n)[None, :] >= lengths[:, None]] = 0
    return before, after, total, chance


def best_paths(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Tags of the best path of each padded window (ties: the smaller tag, from the end)."""
    b, n, k = scores.shape
    best, back = np.array(scores), np.zeros((b, n, k), np.int8)
    for t in range(1, n):
        reach = best[:, t - 1, :, None] + steps
        back[:, t] = reach.argmax(axis=1)
        best[:, t] += reach.max(axis=1)
    path = np.zeros((b, n), np.int8)
    for t in range(n - 1, -1, -1):
        onward = back[np.arange(b), t + 1, path[:, t + 1]] if t + 1 < n else 0
        path[:, t] = np.where(t == lengths - 1, best[:, t].argmax(axis=1), np.where(t < lengths, onward, 0))
    return path


def _padded(rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of windows as (window, place, ...), zeros after a window's end."""
    out = np.zeros((len(starts), int(lengths.max()), *rows.shape[1:]), rows.dtype)
    place = np.arange(out.shape[1])[None, :]
    real = place < lengths[:, None]
    out[real] = rows[(starts[:, None] + place)[real]]
    return out


def decode(model: Tagger, features: np.ndarray, sizes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Tag and its probability for each token of texts that have ``sizes`` tokens."""
    tags, chance = np.zeros(len(features), np.int8), np.zeros(len(features))
    scores = model.weights[features].sum(axis=1)
    edges = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    cuts = np.array([[at + w for w in win] for at, n in zip(edges, sizes) for win in windows(n)], np.int64).reshape(-1, 4)
    for i in range(0, len(cuts), GROUP):
        first, end, keep, keep_end = cuts[i:i + GROUP].T
        padded = _padded(scores, first, end - first)
        path = best_paths(padded, end - first, model.steps)
        share = forward_backward(padded, end - first, model.steps)[3]
        place = first[:, None] + np.arange(padded.shape[1])[None, :]
        kept = (place >= keep[:, None]) & (place < keep_end[:, None])
        tags[place[kept]] = path[kept]
        chance[place[kept]] = np.take_along_axis(share, path[:, :, None].astype(np.int64), 2)[:, :, 0][kept]
    return tags, chance


def join_tags(names: Sequence[str], tags: np.ndarray, chance: np.ndarray) -> list[tuple[int, int, str, float]]:
    """(first token, end token, label, mean probability): neighbours of one label are one
    span until a begin tag; an inside tag after another label opens a span."""
    kinds = [(name.startswith("B-"), name[2:]) for name in names]
    met = np.flatnonzero(tags)  # tag 0 is O
    spans: list[tuple[int, int, str]] = []
    first, end, label = 0, 0, ""
    for i, t in zip(met.tolist(), tags[met].tolist()):
        begins, kind = kinds[t]
        if label and (i != end or kind != label or begins):
            spans.append((first, end, label))
            label = ""
        if not label:
            first, label = i, kind
        end = i + 1
    if label:
        spans.append((first, end, label))
    return [(a, z, kind, float(np.mean(chance[a:z])) if z - a > 1 else float(chance[a])) for a, z, kind in spans]


def gold_tags(names: Sequence[str], offsets: np.ndarray, spans: Sequence[dict]) -> np.ndarray:
    """Tag of each token: begin at a span's first token, inside at its others."""
    at = {n: i for i, n in enumerate(names)}
    out = np.zeros(len(offsets), np.int8)
    for s in spans:
        met = np.flatnonzero((offsets[:, 0] < s["end"]) & (offsets[:, 1] > s["start"]))
        if len(met):
            out[met] = at["I-" + s["label"]]
            out[met[0]] = at["B-" + s["label"]]
    return out


def window_gradient(weights: np.ndarray, steps: np.ndarray, features: np.ndarray, gold: np.ndarray,
                    starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What windows add to the gradient of the log likelihood: (tokens x tags) for all
    features of a token, (tags x tags) of each window for the steps, and their likelihoods."""
    scores = _padded(weights[features].sum(axis=1), starts, lengths)
    before, after, total, chance = forward_backward(scores, lengths, steps)
    b, n, k = scores.shape
    real = np.arange(n)[None, :] < lengths[:, None]
    want = _padded(gold.astype(np.int64), starts, lengths)
    hit = np.zeros(scores.shape)
    np.put_along_axis(hit, want[:, :, None], 1, 2)
    hit *= real[:, :, None]
    moves = np.zeros((b, k, k))
    likely = (scores * hit).sum(axis=(1, 2)) - total
    for t in range(1, n):
        inside = real[:, t]
        pair = before[:, t - 1, :, None] + steps + (scores[:, t] + after[:, t])[:, None, :] - total[:, None, None]
        moves[inside] -= np.exp(pair[inside])
        moves[np.flatnonzero(inside), want[inside, t - 1], want[inside, t]] += 1
        likely[inside] += steps[want[inside, t - 1], want[inside, t]]
    return (hit - chance)[real], moves, likely


def fit_tagger(examples: DataFrame, text_col: str, spans_col: str, labels: Sequence[str], buckets: int = BUCKETS,
               passes: int = PASSES, rate: float = RATE, decay: float = DECAY) -> tuple[Tagger, list[float]]:
    """Tagger fitted on all rows of ``examples`` (spans as ``SPAN_TYPE``; null spans: none,
    null texts: no tokens), and the mean log likelihood of a token before each pass.

    Without a token all weights stay zero, so every tag is ``O``.
    """
    names = tag_names(labels)
    k = len(names)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordFeatures(buckets)
        for batch in batches:
            for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, offsets = tokenize(text or "")
                if not words:
                    continue
                rows, tags = coder(words), gold_tags(names, offsets, spans or [])
                cuts = range(0, len(words), WINDOW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[i:i + WINDOW].ravel() for i in cuts], pa.list_(pa.int32())),
                     pa.array([tags[i:i + WINDOW] for i in cuts], pa.list_(pa.int8()))], names=["f", "y"])

    rows = examples.select(F.col(text_col), F.col(spans_col).cast(SPAN_TYPE))
    coded = materialize(rows.mapInArrow(code, "f array<int>, y array<tinyint>"), "tagger_windows")
    n = coded.agg(F.coalesce(F.sum(F.size("y")), F.lit(0))).first()[0]
    weights, steps = np.zeros((buckets, k)), np.zeros((k, k))
    if not n:
        return Tagger(names, weights, steps), []

    def share(weights: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Gradient by bucket, then by tag before, then (likelihood, 0, ...)."""
        bc = examples.sparkSession.sparkContext.broadcast((weights, steps))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, s = bc.value
            total = np.zeros((buckets + k + 1, k), np.int64)
            for batch in batches:
                for i in range(0, batch.num_rows, GROUP):
                    part = batch.slice(i, GROUP)
                    lengths = np.asarray(part.column("y").value_lengths(), np.int64)
                    feats = np.asarray(part.column("f").flatten(), np.int64).reshape(-1, FEATURES)
                    gold = np.asarray(part.column("y").flatten(), np.int64)
                    starts = np.cumsum(lengths) - lengths
                    push, moves, likely = window_gradient(w, s, feats, gold, starts, lengths)
                    push = np.repeat(np.rint(push * UNIT), FEATURES, axis=0)
                    for y in range(k):  # below 2 ** 53, so the sums of doubles are exact
                        total[:buckets, y] += np.bincount(feats.ravel(), push[:, y], buckets).astype(np.int64)
                    total[buckets:buckets + k] += np.rint(moves * UNIT).astype(np.int64).sum(axis=0)
                    total[-1, 0] += np.rint(likely * UNIT).astype(np.int64).sum()
            met = np.flatnonzero(total.any(axis=1))
            lists = pa.ListArray.from_arrays(np.arange(len(met) + 1, dtype=np.int32) * k, total[met].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), lists], names=["bucket", "g"])

        parts = coded.mapInArrow(run, "bucket int, g array<bigint>")
        sums = parts.groupBy("bucket").agg(*[F.sum(F.col("g")[i]).alias(f"g{i}") for i in range(k)])
        got = sums.toPandas().to_numpy(np.int64)  # at most one row a bucket
        bc.unpersist()
        out = np.zeros((buckets + k + 1, k))
        out[got[:, 0]] = got[:, 1:] / UNIT
        return out / n

    flat = np.zeros((buckets + k, k))
    mean, square = np.zeros(flat.shape), np.zeros(flat.shape)
    likelihoods = []
    for i in range(1, passes + 1):
        got = share(flat[:buckets], flat[buckets:])
        likelihoods.append(float(got[-1, 0]))
        g = got[:-1] - decay * flat
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        flat += rate * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.99 ** i)) + 1e-8)
    return Tagger(names, flat[:buckets], flat[buckets:]), likelihoods


def tag_entities(df: DataFrame, text_col: str, model: Tagger, keep: Sequence[str] = ()) -> DataFrame:
    """G1 + C12 + B8: one row per span of the whole text, in order: ``pos`` (from 0),
    ``start`` and ``end`` (characters of the text, end excluded), ``entity_text`` (cleaned,
    two characters or more), ``entity_label`` and ``score``, the mean probability of its
    tokens' tags.  Null and empty texts have no spans."""
    coded = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    bc = df.sparkSession.sparkContext.broadcast(model)
    own = [("pos", "bigint"), ("start", "int"), ("end", "int"), ("entity_text", "string"), ("entity_label", "string"), ("score", "double")]
    kept_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.drop("__text").schema)
    schema = ", ".join(filter(None, [kept_types, *(f"`{n}` {t}" for n, t in own)]))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bc.value
        coder = WordFeatures(len(m.weights))

        def spans_of(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            found, at = [], 0
            sizes = [len(words) for _, _, words, _ in texts]
            tags, chance = decode(m, np.vstack([coder(words) for _, _, words, _ in texts]), sizes)
            for (row, text, words, offsets) in texts:
                spans = join_tags(m.tags, tags[at:at + len(words)], chance[at:at + len(words)])
                at += len(words)
                for pos, (first, end, label, score) in enumerate(spans):
                    a, z = int(offsets[first, 0]), int(offsets[end - 1, 1])
                    found.append((row, pos, a, z, text[a:z], label, score))
            columns = list(zip(*found)) or [()] * (len(own) + 1)
            rows = pa.array(columns[0], pa.int64())
            kept = [batch.column(c).take(rows) for c in keep]
            values = [pa.array(c, t) for c, t in zip(columns[1:], types)]
            return pa.RecordBatch.from_arrays([*kept, *values], names=[*keep, *(n for n, _ in own)])

        for batch in batches:
            texts, waiting = [], 0
            for row, text in enumerate(batch.column("__text")):
                text = text.as_py() or ""
                words, offsets = tokenize(text)
                if not words:
                    continue
                texts.append((row, text, words, offsets))
                waiting += len(words)
                if waiting >= CELLS:
                    yield spans_of(batch, texts)
                    texts, waiting = [], 0
            if texts:
                yield spans_of(batch, texts)

    spans = coded.mapInArrow(run, schema).withColumn("entity_text", clean_span("entity_text"))
    return filter_min_length(spans, "entity_text", 2)


def spans_in_order(text: str, mentions: str) -> Column:
    """``SPAN_TYPE`` of mentions, structs of (span, label) in the order in which they stand
    in the text: each is looked for from the end of the one before.  Both arguments name
    columns."""
    empty = "cast(array() as array<struct<start:int,end:int,label:string>>)"
    found = f"locate(m.span, `{text}`, acc.at + 1)"
    return F.expr(
        f"aggregate(`{mentions}`, named_struct('at', 0, 'out', {empty}), (acc, m) -> named_struct("
        f"'at', {found} - 1 + length(m.span), 'out', concat(acc.out, array(named_struct("
        f"'start', {found} - 1, 'end', {found} - 1 + length(m.span), 'label', m.label)))), acc -> acc.out)")
