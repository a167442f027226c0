"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The model file is read as it is (never trained or copied).  Text is cut in
words at every place before a space mark that no piece crosses; each distinct
word is encoded once per chunk.  Words of equal length advance together: at
each character position all substrings that end there are hashed, the hashes
are probed in the sorted piece keys, and the best predecessor by a vectorised
maximum is stored as a backpointer.

What is maximised depends on the model.  Unigram models: the sum of the piece
scores.  BPE models: a segmentation is the merge result if and only if each two
neighbours are what the merges give for their joint string, so a path's score
is the number of characters it covers by such pairs: exactly one predecessor
continues at each place.  Pairs are settled once by running the merges on the
two pieces, then remembered.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .arrow import chunks

SPACE = "▁"
BPE, UNIGRAM = 2, 1
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_WORDS = 60_000    # distinct words after which a worker starts to forget
BATCH_WORDS = 8192      # words that advance together
_BASES = (np.uint64(1099511628211), np.uint64(6364136223846793005))  # of two hashes: one is probed, the other confirms
_LENGTH, _MASK, _SPREAD = 0x9E3779B97F4A7C15, (1 << 64) - 1, np.uint64(0xD6E8FEB86659FD93)
TEXT_BYTES = 4 << 20    # of the texts whose distinct words are encoded together


def _varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (b[i] & 127) << shift
        i += 1
        if b[i - 1] < 128:
            return n, i
        shift += 7


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol-buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            value, i = b[i:i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = b[i:i + n], i + n
        yield key >> 3, value


class Model:
    """Pieces, scores and types of a model file.

    Supported: identity normalisation, escaped white space, BPE or unigram with
    byte fallback, pieces that hold a space mark only in front.  Anything else
    is refused when the model is read.
    """

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.dummy_prefix, remove_extra, charsmap = UNIGRAM, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f[1].decode())
                self.scores.append(float(np.frombuffer(f[2], "<f4")[0]) if 2 in f else 0.0)
                self.types.append(f.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                f = dict(_fields(value))
                self.dummy_prefix, remove_extra = bool(f.get(3, 1)), bool(f.get(4, 1))
                charsmap = f.get(2, b"")
        usable = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == NORMAL}
        byte = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        if remove_extra or charsmap or len(byte) != 256 or USER in self.types or self.kind not in (BPE, UNIGRAM):
            raise ValueError("this model needs normalisation or pieces that are not supported")
        if any(SPACE in p.lstrip(SPACE) for p in usable):
            raise ValueError("a piece holds a space mark behind another character")
        self.usable, self.byte = usable, [byte[k] for k in range(256)]
        self.surface = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t in (CONTROL, UNUSED) else p.replace(SPACE, " ").encode()
                        for p, t in zip(self.pieces, self.types, strict=True)]


class KeyTable:
    """64-bit keys to their order of arrival, by open addressing; probes and
    insertions are vectorised."""

    def __init__(self, bits: int = 17):
        self.bits, self.keys, self.n = bits, np.zeros(1 << 10, np.uint64), 0
        self.slots = np.full(1 << bits, -1, np.int32)

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 if it is not known."""
        at = self._start(keys)
        out = self.slots[at]
        todo = np.flatnonzero(out >= 0)
        todo = todo[self.keys[out[todo]] != keys[todo]]
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            out[todo] = self.slots[at[todo]]
            todo = todo[out[todo] >= 0]
            todo = todo[self.keys[out[todo]] != keys[todo]]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Append distinct keys that are not known yet."""
        if self.n + len(keys) > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros(self.n + 2 * len(keys), np.uint64)])
        self.keys[self.n:self.n + len(keys)] = keys
        first, self.n = self.n, self.n + len(keys)
        if 2 * self.n > len(self.slots):
            self.bits = max(self.bits + 1, (2 * self.n).bit_length())
            self.slots = np.full(1 << self.bits, -1, np.int32)
            first = 0
        number = np.arange(first, self.n, dtype=np.int32)
        at = self._start(self.keys[number])
        while len(number):
            free = np.flatnonzero(self.slots[at] < 0)
            self.slots[at[free]] = number[free]  # of several for one slot the last is in
            lost = self.slots[at] != number
            number, at = number[lost], (at[lost] + 1) & ((1 << self.bits) - 1)


class Encoder:
    """Words to piece ids; keeps what it has learned about words and pairs."""

    def __init__(self, model: Model):
        self.m = model
        runs = {p for p in model.usable if not p.strip(SPACE)}  # of two and more marks: handled as runs
        own = {p: i for p, i in model.usable.items() if p not in runs or len(p) == 1}
        if model.kind == BPE:  # pieces that the merges never produce can't stand in a result
            own = {p: i for p, i in own.items() if len(p) == 1 or self.merges(p) == [p]}
        self.longest = max(map(len, own), default=1)
        self.joined = {p[i:i + 2] for p in own for i in range(len(p) - 1)}  # characters that some piece holds side by side
        by_length: dict[int, list[str]] = {}
        for piece in own:
            by_length.setdefault(len(piece), []).append(piece)
        found = []
        for n, group in by_length.items():
            keys, check = (self._prefixes(self._points(group), base)[:, n] for base in _BASES)
            found += [(k + n * _LENGTH & _MASK, c, own[p]) for k, c, p in zip(keys.tolist(), check.tolist(), group, strict=True)]
        found.sort()
        self.table = KeyTable()
        self.table.add(np.array([k for k, _, _ in found], np.uint64))
        self.check = np.array([c for _, c, _ in found], np.uint64)
        self.ids = np.array([i for _, _, i in found], np.int64)
        self.score = np.array(model.scores + [min(model.scores, default=0.0) - 10.0])
        self.unknown = len(model.pieces)  # any character that is no piece
        self.pairs, self.pair_ok = KeyTable(), np.zeros(0, bool)
        # word (without its mark) -> ids; rest of a cut word -> ids; the last
        # generation of each serves once more before it is forgotten
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.run_ids: dict[int, list[int]] = {}

    @staticmethod
    def _points(words: Sequence[str]) -> np.ndarray:
        joined = "".join(words).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(joined, np.uint32).reshape(len(words), -1).astype(np.uint64)

    @staticmethod
    def _prefixes(points: np.ndarray, base: np.uint64) -> np.ndarray:
        """Hash of the first i characters of each row, i from 0."""
        out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        for i in range(points.shape[1]):
            out[:, i + 1] = out[:, i] * base + points[:, i] + np.uint64(1)
        return out

    def merges(self, text: str) -> list[str]:
        """The merge rule: join the neighbours with the best scored joint
        piece, leftmost first, until none is left."""
        score, usable = self.m.scores, self.m.usable
        if len(text) > 64:
            return self._merges_long(text)
        rate = lambda a, b: score[k] if (k := usable.get(a + b)) is not None else -np.inf
        parts = list(text)
        gains = [rate(a, b) for a, b in zip(parts, parts[1:], strict=False)]
        while gains and (top := max(gains)) > -np.inf:
            i = gains.index(top)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i:
                gains[i - 1] = rate(parts[i - 1], parts[i])
            if i < len(gains):
                gains[i] = rate(parts[i], parts[i + 1])
        return parts

    def _merges_long(self, text: str) -> list[str]:
        """The same with a heap of offers."""
        score, usable = self.m.scores, self.m.usable
        left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        parts: list = list(text)
        heap: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (k := usable.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score[k], i, j, len(parts[i]), len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or right[i] != j or (len(parts[i]), len(parts[j])) != (a, b):
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave pieces a, b side by side."""
        free = (a == self.unknown) | (b == self.unknown)
        keys = (a * (self.unknown + 1) + b).astype(np.uint64)
        at = self.pairs.find(keys)
        if new := set(keys[(at < 0) & ~free].tolist()):
            pieces = self.m.pieces
            ok = [self.merges(x + y) == [x, y] for k in new
                  for x, y in ((pieces[k // (self.unknown + 1)], pieces[k % (self.unknown + 1)]),)]
            self.pairs.add(np.array(list(new), np.uint64))
            self.pair_ok = np.concatenate([self.pair_ok, np.array(ok)])
            at = self.pairs.find(keys)
        ok = free.copy()
        ok[~free] = self.pair_ok[at[~free]]
        return ok

    def _viterbi(self, words: Sequence[str]) -> list[bytes]:
        """Piece ids (int32) of words of one length."""
        n, length = len(words), len(words[0])
        points = self._points(words)
        one, two = (self._prefixes(points, base) for base in _BASES)
        powers = [np.array([pow(int(base), k, 1 << 64) for k in range(self.longest + 1)], np.uint64) for base in _BASES]
        salt = np.array([k * _LENGTH & _MASK for k in range(self.longest + 1)], np.uint64)
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        piece = np.full((n, length + 1), -1, np.int64)
        back = np.zeros((n, length + 1), np.int64)
        for i in range(1, length + 1):
            sizes = np.arange(1, min(i, self.longest) + 1)
            h = one[:, i, None] - one[:, i - sizes] * powers[0][sizes] + salt[sizes]
            at = self.table.find(h.ravel())
            flat = np.flatnonzero(at >= 0)
            row, col = np.divmod(flat, len(sizes))
            at, size = at[flat], sizes[col]
            good = (two[row, i] - two[row, i - size] * powers[1][size] == self.check[at]) & (best[row, i - size] > -np.inf)
            row, size, cand = row[good], size[good], self.ids[at[good]]
            lone = best[:, i - 1] > -np.inf  # a character that is no piece is one unknown
            lone[row[size == 1]] = False
            if lone.any():
                row = np.concatenate([row, np.flatnonzero(lone)])
                size = np.concatenate([size, np.ones(lone.sum(), np.int64)])
                cand = np.concatenate([cand, np.full(lone.sum(), self.unknown)])
            if self.m.kind == BPE:
                ok = i == size
                ok[~ok] = self._pairs(piece[row[~ok], i - size[~ok]], cand[~ok])
                row, size, cand = row[ok], size[ok], cand[ok]
                gain = np.full(len(row), float(i))
            else:
                gain = best[row, i - size] + self.score[cand]
            np.maximum.at(best[:, i], row, gain)
            won = gain == best[row, i]
            row = row[won]
            piece[row, i], back[row, i] = cand[won], i - size[won]
        # all backtraces at once, from the end
        path, place, lanes = [], np.full(n, length), np.arange(n)
        while place.any():
            path.append(np.where(place > 0, piece[lanes, place], -1))
            place = back[lanes, place]
        ids = np.array(path).T[:, ::-1] if path else np.zeros((n, 0), np.int64)
        known = (ids >= 0).sum(axis=1)
        plain = ~(ids == self.unknown).any(axis=1)
        flat = ids.astype("<i4")
        width = ids.shape[1]
        return [flat[w, width - known[w]:].tobytes() if plain[w] else self._with_bytes(words[w], ids[w, width - known[w]:])
                for w in range(n)]

    def _with_bytes(self, word: str, ids: np.ndarray) -> bytes:
        """Unknown characters as the pieces of their UTF-8 bytes."""
        out: list[int] = []
        at = 0
        for i in ids.tolist():
            if i == self.unknown:
                out.extend(self.m.byte[b] for b in word[at].encode("utf-8", "replace"))
                at += 1
            else:
                out.append(i)
                at += len(self.m.pieces[i])
        return np.array(out, "<i4").tobytes()

    def _cut(self, word: str) -> list[str]:
        """The word cut where no piece holds the two characters side by side:
        no merge and no piece crosses such a place."""
        joined, out, start = self.joined, [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in joined:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def run_of_spaces(self, n: int) -> list[int]:
        """Ids of n space marks in a row."""
        if n not in self.run_ids:
            self.run_ids[n] = [self.m.usable[p] for p in self.merges(SPACE * n)] if self.m.kind == BPE else \
                _best_runs(n, {len(p): (self.m.scores[i], i) for p, i in self.m.usable.items() if not p.strip(SPACE)})
        return self.run_ids[n]

    def learn(self, words: set[str]) -> None:
        """Encode the words not known yet, their parts by length."""
        if len(self.words) > CACHE_WORDS:
            self.words, self.old, self.tails = {}, self.words, {}
        known, old = self.words, self.old
        cut: dict[str, list[str]] = {}
        heads, tails = set(), set()
        for w in words:
            if w in known:
                continue
            if w in old:
                known[w] = old[w]
            elif w.isalpha():  # most of these can't be cut
                heads.add(w)
            else:
                parts = self._cut(SPACE + w)
                cut[w] = parts
                if parts[0] != SPACE:
                    heads.add(parts[0][1:])
                tails.update(p for p in parts[parts[0] != SPACE:] if p not in self.tails)
        heads = {w for w in heads if w not in known}
        by_length: dict[int, list[str]] = {}
        for group, mark in ((heads, SPACE), (tails, "")):
            for w in group:
                by_length.setdefault(len(w) + len(mark), []).append(mark + w)
        for length, group in by_length.items():
            size = max(1, min(BATCH_WORDS, (1 << 20) // (length + 1)))
            for i in range(0, len(group), size):
                part = group[i:i + size]
                for w, ids in zip(part, self._viterbi(part), strict=True):
                    if w[0] == SPACE and len(w) > 1:
                        known[w[1:]] = ids
                    else:
                        self.tails[w] = ids
        for w, parts in cut.items():
            head = [] if parts[0] == SPACE else [known[parts[0][1:]]]
            known[w] = b"".join(head + [self.tails[p] for p in parts[len(head):]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each text."""
        split = [t.replace(SPACE, " ").split(" ") if t else [] for t in texts]
        if not self.m.dummy_prefix:
            raise ValueError("models without a dummy prefix are not supported")
        self.learn({w for parts in split for w in parts if w})
        words = self.words
        out = []
        for parts in split:
            if "" not in parts:
                out.append(b"".join([words[w] for w in parts]))
                continue
            ids: list[bytes] = []
            marks = 0  # marks in front that no word has taken
            for w in parts:
                if not w:
                    marks += 1
                    continue
                got = words[w]
                if marks:  # the last mark belongs to the word if a piece joins them
                    alone = int.from_bytes(got[:4], "little") == self.m.usable.get(SPACE, -1)
                    ids.append(np.array(self.run_of_spaces(marks + alone), np.int32).tobytes())
                    got = got[4 * alone:]
                    marks = 0
                ids.append(got)
            if marks:
                ids.append(np.array(self.run_of_spaces(marks), np.int32).tobytes())
            out.append(b"".join(ids))
        return out


def _best_runs(n: int, runs: dict[int, tuple[float, int]]) -> list[int]:
    """Best-scored way to lay n marks out of the given runs (unigram)."""
    best: list = [(0.0, 0, 0)] + [None] * n
    for i in range(1, n + 1):
        best[i] = max(((best[i - k][0] + s, k, p) for k, (s, p) in runs.items() if k <= i), key=lambda x: (x[0], -x[1]))
    out = []
    while n:
        out.append(best[n][2])
        n -= best[n][1]
    return out[::-1]


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, ids``.

    ``ids`` are the piece ids of the whole text: empty for an empty text, null
    for a null one.  A space mark in the text counts as a space, a lone
    surrogate as the replacement character.  Repeated rows are encoded each; an
    empty table gives an empty result; other columns are ignored, whatever
    their names.
    """
    id_field = docs.select(F.col(f"`{id_col}`").alias("doc_id")).schema.fields[0]
    schema = StructType([id_field, StructField("text", StringType()), StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in chunks(batches, "text", TEXT_BYTES):
            texts = batch.column("text").to_pylist()
            found = encoder.encode([t or "" for t in texts])
            offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")),
                mask=pa.array([t is None for t in texts], pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), lists], names=["doc_id", "text", "ids"])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def decode(coded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``coded`` without ``ids_col``, plus ``decoded``: the text of the ids
    without the dummy prefix; bytes that are no UTF-8 become the replacement
    character; null ids: null."""
    keep = [f for f in coded.schema.fields if f.name != ids_col]
    schema = StructType([*keep, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(model)
        surface = np.array(m.surface, object)
        for batch in _slices(batches):
            lists = batch.column(ids_col)
            texts = []
            for i in range(len(lists)):
                if not lists[i].is_valid:
                    texts.append(None)
                    continue
                raw = b"".join(surface[lists[i].values.to_numpy()].tolist())
                texts.append((raw[1:] if m.dummy_prefix and raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), pa.array(texts, pa.string())], names=[*(f.name for f in keep), "decoded"])

    return coded.mapInArrow(run, schema)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    """One encoder a worker process: what it learned serves its next tasks."""
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Model(model))
    return _ENCODERS[key]
