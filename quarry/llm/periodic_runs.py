"""Periodic runs of words, found on a grammar of the text.

The word ids of a text are compressed by Re-Pair: the commonest pair of
neighbouring symbols becomes a rule, until no pair occurs twice.  Pairs that
touch no commoner pair are replaced in the same round, so many documents go
through few rounds together, one numpy pass each.

A run lies inside some node of the grammar and crosses that node's middle: the
boundary of a rule's two halves, or a boundary between symbols of the start
sequence.  Runs are therefore looked for at boundaries only, once per rule:

* at a boundary, a period from 2 ** j to 2 ** (j + 1) - 1 shows as a window of
  2 ** j words, to the right or to the left, that occurs again at that distance;
* words that are equal that far apart are extended both ways, to the ends of
  the node's text, over names of windows of 2 ** j words (equal names, equal words);
* what a rule holds is carried to every place the rule derives, and intervals of
  one period that share at least a period are merged.

Names are exact ranks, not hashes.  A window must occur three times in its text
to be named: every window of a run that is no longer than the period does, so
ordinary prose is left after a few levels.

Memory of a task follows the longest text: about 8 bytes a word for each
doubling of the window up to the longest repeated one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import chunks

MIN_LENGTH = 6      # words of the shortest run
MIN_EXPONENT = 4    # length over period, at least
SEEN = 3            # times that a window occurs before it is named
SPACES = r"[\x20\x09-\x0D]+"


def re_pair(ids: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Grammar of ``ids`` (below their number, no id in two documents).

    Returns the places where symbols of the start sequence begin, (rule, place)
    of every derivation of every rule, and (length of the left half, length) by rule.
    """
    n = len(ids)
    base = 2 * n + 1
    sym, start, length = ids.astype(np.int64), np.arange(n), np.ones(n, np.int64)
    dead = np.zeros(n, bool)        # the pair that begins here occurs once
    keys = np.zeros(0, np.int64)    # pairs that have a rule, ascending, with the rule's number
    rule_of = np.zeros(0, np.int64)
    found, halves, wholes = [], [], []
    while len(sym) > 1:
        alive = np.flatnonzero(~dead[:-1])
        if not len(alive):
            break
        pairs, at, count = np.unique(sym[alive] * base + sym[alive + 1], return_inverse=True, return_counts=True)
        rank = np.zeros(len(sym) + 1, np.int64)  # commoner pairs rank higher; 0: occurs once.  One place more on the left
        rank[alive + 1] = np.where(count[at] >= 2, count[at] * (len(pairs) + 1) + at, 0)
        dead = rank[1:] == 0
        mine = rank[1:-1]
        best = np.flatnonzero((mine > 0) & (mine >= rank[:-2]) & (mine >= rank[2:]))
        if not len(best):
            break
        # neighbours that are both best are one pair over and over (a a a a): every second one
        first = np.r_[True, np.diff(best) != 1]
        since = np.maximum.accumulate(np.where(first, np.arange(len(best)), 0))
        chosen = best[(np.arange(len(best)) - since) % 2 == 0]
        key = sym[chosen] * base + sym[chosen + 1]
        new, one = np.unique(key, return_index=True)
        new, one = new[~np.isin(new, keys)], one[~np.isin(new, keys)]
        number = np.arange(len(rule_of), len(rule_of) + len(new))
        halves.append(length[chosen[one]])
        wholes.append(length[chosen[one]] + length[chosen[one] + 1])
        keys, rule_of = np.r_[keys, new], np.r_[rule_of, number]
        order = np.argsort(keys)
        keys, rule_of = keys[order], rule_of[order]
        rule = rule_of[np.searchsorted(keys, key)]
        found.append((rule, start[chosen]))
        sym[chosen] = n + rule
        length[chosen] += length[chosen + 1]
        changed = np.zeros(len(sym), bool)
        changed[chosen] = True
        stays = np.ones(len(sym), bool)
        stays[chosen + 1] = False
        sym, start, length, dead, changed = sym[stays], start[stays], length[stays], dead[stays], changed[stays]
        dead &= ~(changed | np.r_[changed[1:], False])
    cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return start, (cat([f[0] for f in found]), cat([f[1] for f in found])), (cat(halves), cat(wholes))


def window_names(ids: np.ndarray) -> list[np.ndarray]:
    """By j, the name of the window of 2 ** j words that begins at each place:
    equal names for equal windows, -1 for windows that occur fewer than SEEN
    times.  The last list has a name at least."""
    count = np.bincount(ids, minlength=1)
    names = [np.where(count[ids] >= SEEN, ids, -1)]
    while True:
        before, half = names[-1], 1 << (len(names) - 1)
        if len(before) <= half:
            return names
        at = np.flatnonzero((before[:-half] >= 0) & (before[half:] >= 0))
        if not len(at):
            return names
        _, name, count = np.unique(before[at] * (len(ids) + 1) + before[at + half], return_inverse=True, return_counts=True)
        now = np.full(len(ids), -1, np.int64)
        now[at] = np.where(count[name] >= SEEN, name, -1)
        if (now < 0).all():
            return names
        names.append(now)


def _extend(ids: np.ndarray, names: list[np.ndarray], x: np.ndarray, y: np.ndarray, end: np.ndarray, step: int) -> np.ndarray:
    """Words that agree from places x and y on (``step`` 1), or before them
    (-1), until y reaches ``end`` (or x, going back)."""
    done = np.zeros(len(x), np.int64)
    for j in range(len(names) - 1, -1, -1):
        size, name = 1 << j, ids if j == 0 else names[j]
        todo = np.arange(len(x))
        while len(todo):
            if step > 0:
                todo = todo[y[todo] + done[todo] + size <= end[todo]]
                a, b = x[todo] + done[todo], y[todo] + done[todo]
            else:
                todo = todo[x[todo] - done[todo] - size >= end[todo]]
                a, b = x[todo] - done[todo] - size, y[todo] - done[todo] - size
            todo = todo[(name[a] == name[b]) & (name[a] >= 0)]
            done[todo] += size
    return done


def _crossing(ids: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, min_length: int, min_exponent: int):
    """(task, start, end, period) of stretches that cross place ``at[task]``,
    keep a period and have the asked length within ``lo`` and ``hi``."""
    names = window_names(ids)
    n = len(ids)
    out = []
    known = np.zeros((3, len(at)), np.int64)  # a run of each task so far: start, end, period
    for j, name in enumerate(names):
        size = 1 << j
        seen = np.flatnonzero(name >= 0)
        places = np.sort(name[seen] * n + seen)  # by name, then place
        found = []
        for right in (True, False):
            x = at if right else at - size
            task = np.flatnonzero((x >= lo) & (x + size <= hi))
            task = task[name[x[task]] >= 0]
            x = x[task]
            # the same window, one to two window lengths away
            away = (x + size, np.minimum(x + 2 * size, hi[task] - size + 1)) if right else (
                np.maximum(x - 2 * size + 1, lo[task]), x - size + 1)
            first, last = (np.searchsorted(places, name[x] * n + np.clip(y, 0, n)) for y in away)
            hits = np.maximum(last - first, 0)
            other = places[np.repeat(first - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())] % n
            x, t = np.repeat(x, hits), np.repeat(task, hits)
            found.append((t, np.minimum(x, other), np.maximum(x, other)))
        t, a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        begin, end, period = known[:, t]
        # multiples of a known run's period, inside it, are that run again
        new = (period == 0) | ((b - a) % np.maximum(period, 1) != 0) | (a < begin) | (b + size > end)
        t, a, b = t[new], a[new], b[new]
        if not len(t):
            continue
        begin = a - _extend(ids, names, a, b, lo[t], -1)
        end = b + _extend(ids, names, a, b, hi[t], 1)
        good = end - begin >= np.maximum(min_length, min_exponent * (b - a))
        runs = np.stack([t, begin, end, b - a])[:, good]
        known[:, runs[0]] = runs[1:]
        out.append(runs)
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)


def runs_of(ids: np.ndarray, doc_starts: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """``start, end, period`` (columns; places in ``ids``) of all runs, by start
    and period.  ``min_exponent`` of 4 or more; ids as :func:`re_pair` takes them."""
    if min_exponent < MIN_EXPONENT:
        raise ValueError("windows are found by their third occurrence: min_exponent must be at least 4")
    n = len(ids)
    if n < min_length:
        return np.zeros((0, 3), np.int64)
    top, (rule, place), (half, whole) = re_pair(ids)
    edges = np.r_[doc_starts, n]
    bounds = top[~np.isin(top, edges)]
    doc = np.searchsorted(edges, bounds, "right") - 1
    order = np.lexsort((place, rule))
    rule, place = rule[order], place[order]
    first = np.searchsorted(rule, np.arange(len(half)))   # each rule derives somewhere
    times = np.diff(np.r_[first, len(rule)])
    big = np.flatnonzero(whole >= min_length)
    home = place[first[big]]
    task, start, end, period = _crossing(
        ids, np.r_[bounds, home + half[big]], np.r_[edges[doc], home], np.r_[edges[doc + 1], home + whole[big]],
        min_length, min_exponent)
    in_rule = task >= len(bounds)
    r = big[task[in_rule] - len(bounds)]
    copies = times[r]
    shift = place[np.repeat(first[r], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)]
    shift = shift - np.repeat(place[first[r]], copies)
    spread = lambda c: np.repeat(c[in_rule], copies)
    start = np.r_[start[~in_rule], spread(start) + shift]
    end = np.r_[end[~in_rule], spread(end) + shift]
    period = np.r_[period[~in_rule], spread(period)]
    if not len(start):
        return np.zeros((0, 3), np.int64)
    # merge intervals of one period that share at least a period
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    far = end + period * (2 * n)  # ascending over periods, so one running maximum serves all
    reach = np.r_[-1, np.maximum.accumulate(far)[:-1]]
    fresh = np.flatnonzero(np.r_[True, np.diff(period) > 0] | (start + period + period * (2 * n) > reach))
    start, period, end = start[fresh], period[fresh], np.maximum.reduceat(end, fresh)
    # a period's multiples keep the same stretch: the least stays
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.r_[True, (np.diff(start) != 0) | (np.diff(end) != 0)]
    out = np.stack([start, end, period], axis=1)[least]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _scan(texts: list[bytes | None], min_length: int, min_exponent: int) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs, words that stay) of each text."""
    words = [(t or b"").split() for t in texts]  # bytes split at the six ASCII spaces
    starts = np.cumsum([0] + [len(w) for w in words])
    ids: list[int] = []
    for w, begin in zip(words, starts.tolist(), strict=False):
        ids.extend(map({}.setdefault, w, range(begin, begin + len(w))))
    runs = runs_of(np.array(ids, np.int64), starts[:-1], min_length, min_exponent)
    doc = np.searchsorted(starts, runs[:, 0], "right") - 1
    by_doc: dict[int, list[tuple[int, int, int]]] = {}
    for d, (a, b, p) in zip(doc.tolist(), runs.tolist(), strict=True):
        by_doc.setdefault(d, []).append((a - int(starts[d]), b - a, p))
    out = []
    for d, w in enumerate(words):
        own = by_doc.get(d, [])
        if own:
            gone = np.zeros(len(w), bool)
            for a, size, p in own:
                gone[a + p:a + size] = True
            kept = b" ".join([x for x, g in zip(w, gone.tolist(), strict=True) if not g])
        else:
            kept = b" ".join(w)
        out.append((len(w), own, kept))
    return out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, runs array<struct<start,
    length, period>>, collapsed``.

    A run is a stretch of ``min_length`` or more words and ``min_exponent`` or
    more periods (its smallest) that no neighbour extends; runs are ordered by
    start, then period.  ``collapsed`` has the words that lie in no run beyond
    its first period, joined by one space.

    Null, empty and blank texts have no words, no runs and an empty
    ``collapsed``.  Rows are judged alone: repeated rows and repeated or null ids
    give a row each.  An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = _scan(texts, min_length, min_exponent)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in f[1]] for f in found], pa.list_(RUN)),
                pa.array([f[2] for f in found], pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def plant_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with periods planted in a tenth of the documents.

    With h = crc32(id as text), g = h div 10, n words: if h is divisible by 10,
    the words from a = g % n on repeat the first 1 + (n - a) div (3 + g % 8) of
    them.  Other texts, also null ones and those of null ids, stay as they are.
    """
    text = F.col(f"`{text_col}`")
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), h.alias("h"),
                       F.floor(h / 10).alias("g"))

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(F.col("g"), n)

        def word(i: Column) -> Column:
            period = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
            return F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, period)).cast("int"))

        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")

    words = F.array_remove(F.split("text", SPACES), "")
    changed = F.when((F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), _bound(words, planted))
    return rows.select("doc_id", F.coalesce(changed, F.col("text")).alias("text"))
