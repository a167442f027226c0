"""M2 / M3: hierarchical density clustering with noise, exact and without a
radius to choose.

1. *Blocks.*  Equal vectors become one point with a multiplicity.  Points are
   dealt to blocks of bounded size by median cuts learned from a bounded sample;
   the boxes around the blocks (at most ``MAX_BLOCKS`` of them) go to the tasks.
2. *Core distances*: distance to the ``min_samples``-th nearest other vector.
   Each block is searched against itself, then a point is sent to those blocks
   only whose box is nearer than what it has found.
3. *Minimum spanning tree* of the mutual reachability max(core a, core b, |a - b|)
   by Boruvka rounds: every component takes its least edge to another one.  The
   best edge inside a point's own block bounds the search of other blocks, and
   blocks that belong to the same component are passed over.  The components at
   least halve in a round.
4. *Hierarchy.*  Edges in ascending order are merged ``SWEEP_EDGES`` at a time,
   each step a union-find of bounded size over component summaries.  Components
   of ``min_cluster_size`` vectors are clusters; smaller ones that join a cluster
   leave it, seen from above, at that level.  A merge of two clusters closes both
   and decides whether each is worth more than what it is made of (excess of mass).
5. *Labels*: pointer jumping on the cluster tree finds each cluster's topmost
   chosen ancestor.

Equal weights are ordered by ids, so the result depends on the vectors only.
Every round is written to the shared folder: a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..sources.writers import materialize
from .aggregates import consecutive_ids

BLOCK_VALUES = 4096     # numbers in a block: rows times dimensions
MAX_BLOCKS = 1 << 16
SAMPLE_A_BLOCK = 32     # sampled points a block when the cuts are learned
WHOLE_ROWS = 1 << 11    # rows of a block whose distances are held at once
SWEEP_EDGES = 1 << 20   # edges that one union-find holds
SWEEP_ROWS = 1 << 14    # result rows that it holds before it hands them on
NEAREST = 1e-10         # smaller distances count as this in levels (1 / distance)


# --- blocks -----------------------------------------------------------------

def _cuts(sample: np.ndarray, blocks: int) -> list[tuple[int, float, int, int]]:
    """Median cuts as (dimension, value, left, right); a negative child -1 - b is
    block b.  Values up to the cut go left."""
    cuts: list[tuple[int, float, int, int]] = []
    n_blocks = 0

    def split(rows: np.ndarray, want: int) -> int:
        nonlocal n_blocks
        if want > 1 and len(rows) > 1:
            for k in np.argsort(-np.ptp(rows, axis=0), kind="stable"):
                value = np.sort(rows[:, k])[(len(rows) - 1) // 2]
                left = rows[:, k] <= value
                if left.all():
                    continue
                at = len(cuts)
                cuts.append((0, 0.0, 0, 0))
                halves = split(rows[left], want // 2), split(rows[~left], want - want // 2)
                cuts[at] = (int(k), float(value), *halves)
                return at
        n_blocks += 1
        return -n_blocks

    split(sample, blocks)
    return cuts


def _block_of(x: np.ndarray, cuts: list[tuple[int, float, int, int]]) -> np.ndarray:
    node = np.zeros(len(x), np.int64) if cuts else np.full(len(x), -1)
    if cuts:
        dim, value, left, right = (np.array(c) for c in zip(*cuts, strict=True))
        open_ = np.arange(len(x))
        while len(open_):
            at = node[open_]
            node[open_] = np.where(x[open_, dim[at]] <= value[at], left[at], right[at])
            open_ = open_[node[open_] >= 0]
    return -node - 1


def _rows_of(batch: pd.DataFrame, column: str) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in batch[column]]) if len(batch) else np.zeros((0, 1))


def _matrix(row, name: str, d: int) -> np.ndarray:
    return np.asarray(getattr(row, name), np.float64).reshape(-1, d)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed dimension by dimension, so that both directions agree to the bit."""
    total = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        total += gap * gap
    return np.sqrt(total)


def _to_boxes(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Distance of each point to each box, a little too low rather than too high."""
    total = np.zeros((len(x), len(lo)))
    for k in range(x.shape[1]):
        gap = np.maximum(np.maximum(lo[None, :, k] - x[:, k, None], x[:, k, None] - hi[None, :, k]), 0)
        total += gap * gap
    return np.sqrt(total) * (1 - 1e-12)


def _box_gap(lo: np.ndarray, hi: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(los - hi, lo - his), 0)
    return np.sqrt((gap * gap).sum(axis=1)) * (1 - 1e-12)


def _out(x: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Distance of each point to the nearest of the boxes; boxes farther from all points
    than what is found are passed over."""
    out = np.full(len(x), np.inf)
    gap = _box_gap(x.min(axis=0), x.max(axis=0), los, his)
    order = np.argsort(gap, kind="stable")
    for a in range(0, len(order), 64):
        ids = order[a:a + 64]
        if gap[ids[0]] > out.max():
            break
        out = np.minimum(out, _to_boxes(x, los[ids], his[ids]).min(axis=1))
    return out


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[Callable[[slice], np.ndarray], float]:
    """Squared distances of rows of x to all of y by a matrix product, and how far they may be off."""
    middle = y.mean(axis=0)
    a, b = x - middle, y - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    eps, d = np.finfo(np.float64).eps, x.shape[1]
    wide, top = np.sqrt(aa.max(initial=0)) + np.sqrt(bb.max(initial=0)), max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    off = 16 * d * eps * top
    return lambda rows: aa[rows, None] + bb - 2 * (a[rows] @ b.T), float(64 * d * eps * wide * wide + off * wide + off * off)


def _within(x: np.ndarray, y: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in x, places in y, distances) of the pairs within ``bound`` of the x."""
    squares, off = _squares(x, y)
    limit = bound * bound * (1 + 1e-12) + off
    found = []
    for at in range(0, len(x), 512):
        i, j = np.nonzero(squares(slice(at, at + 512)) <= limit[at:at + 512, None])
        i += at
        total = np.zeros(len(i))
        for k in range(x.shape[1]):  # as _distances, to the bit
            gap = x[i, k] - y[j, k]
            total += gap * gap
        dist = np.sqrt(total)
        near = dist <= bound[i]
        found.append((i[near], j[near], dist[near]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _points(df: DataFrame, vec: str, id_col: str) -> tuple[DataFrame, int, int]:
    """``v, m, x, block``: distinct vectors, numbered by their least id, and their
    multiplicity; also their number and dimensions."""
    x = F.col(vec).cast("array<double>")
    whole = F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.filter(whole).groupBy(x.alias("x")).agg(F.min(F.col(id_col)).alias("_id"), F.count(F.lit(1)).alias("m"))
    rows = materialize(consecutive_ids(rows, ["_id", "x"], "v").select("x", "v", "m"), "distinct_vectors")
    n, d, least = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.min(F.size("x"))).first()
    if d != least:
        raise ValueError("vectors must have one length")
    d = d or 1
    blocks = int(min(MAX_BLOCKS, 2 ** np.ceil(np.log2(max(1, n * d / BLOCK_VALUES)))))
    cuts = []
    if blocks > 1:  # a bounded sample, picked by hash
        share = min(1.0, SAMPLE_A_BLOCK * blocks / n)
        picked = rows.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30))).select("x").collect()
        cuts = _cuts(np.array([r[0] for r in picked]), blocks)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(block=_block_of(_rows_of(batch, "x"), cuts).astype(np.int32))

    return rows.mapInPandas(deal, "x array<double>, v long, m long, block int"), n, d


def _packed(points: DataFrame, columns: list[str]) -> DataFrame:
    """One row a block: ``block``, the columns as arrays by id, ``xs`` flat."""
    row = F.sort_array(F.collect_list(F.struct("v", *[c for c in columns if c != "v"], "x")))
    return points.groupBy("block").agg(row.alias("_r")).select(
        "block", *[F.col(f"_r.{c}").alias(c) for c in columns], F.flatten("_r.x").alias("xs"))


def _directory(packed: DataFrame, d: int) -> dict[str, np.ndarray]:
    """Boxes of the blocks, at most about MAX_BLOCKS of them."""
    side = lambda f, k: f(F.filter("xs", lambda _, i: i % d == k))
    rows = packed.select("block", F.array(*[side(F.array_min, k) for k in range(d)]),
                         F.array(*[side(F.array_max, k) for k in range(d)])).collect()
    rows.sort()
    return {"block": np.array([r[0] for r in rows], np.int64), "lo": np.array([r[1] for r in rows]).reshape(-1, d),
            "hi": np.array([r[2] for r in rows]).reshape(-1, d)}


# --- core distances ---------------------------------------------------------

def _nearest(x: np.ndarray, others: np.ndarray, k: int, skip_self: bool) -> tuple[np.ndarray, np.ndarray]:
    """(distances, places) of the k nearest others of each point, ascending."""
    k = min(k, len(others) - skip_self)
    dist, place = np.zeros((len(x), max(k, 0))), np.zeros((len(x), max(k, 0)), np.int64)
    if k <= 0:
        return dist, place
    for a in range(0, len(x), 512):
        part = _distances(x[a:a + 512], others)
        if skip_self:
            part[np.arange(len(part)), np.arange(a, a + len(part))] = np.inf
        near = np.argpartition(part, k - 1, axis=1)[:, :k]
        got = np.take_along_axis(part, near, axis=1)
        order = np.argsort(got, axis=1, kind="stable")
        dist[a:a + 512] = np.take_along_axis(got, order, axis=1)
        place[a:a + 512] = np.take_along_axis(near, order, axis=1)
    return dist, place


_OWN = "block int, v array<long>, m array<long>, xs array<double>, far array<double>, near_d array<double>, near_m array<long>"


def _core(own: np.ndarray, place: np.ndarray, dist: np.ndarray, m: np.ndarray, min_samples: int) -> np.ndarray:
    """Core distance of each point from its copies and from others (``place``: whose) at ``dist``."""
    copies = np.flatnonzero(own > 1)
    place, dist, m = np.r_[copies, place], np.r_[np.zeros(len(copies)), dist], np.r_[own[copies] - 1, m]
    order = np.lexsort((m, dist, place))
    place, dist, m = place[order], dist[order], m[order]
    before = np.cumsum(m) - m
    first = np.searchsorted(place, place)  # the first of the same point
    out = np.zeros(len(own))
    needed = before - before[first] < min_samples  # walk up the distances until enough vectors are counted
    np.maximum.at(out, place[needed], dist[needed])
    return out


def core_distances(points: DataFrame, min_samples: int, n: int, d: int) -> DataFrame:
    """``points`` with ``core``: the distance that ``min_samples`` other vectors
    (copies count) lie within; with fewer others, the farthest of them."""
    packed = materialize(_packed(points, ["v", "m"]), "density_blocks")
    boxes = points.sparkSession.sparkContext.broadcast(_directory(packed, d))

    def reach(m_own, dist, m_near) -> np.ndarray:
        """Distance within which enough others are known; infinite if too few are."""
        total = np.cumsum(m_near, axis=1) + (m_own - 1)[:, None]
        enough = total >= min_samples
        at = enough.argmax(axis=1)
        out = np.where(enough.any(axis=1), np.take_along_axis(dist, at[:, None], axis=1)[:, 0], np.inf) if dist.shape[1] else np.full(len(dist), np.inf)
        return np.where(m_own > min_samples, 0.0, out)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                x, m = _matrix(r, "xs", d), np.asarray(r.m)
                dist, place = _nearest(x, x, min_samples, True)
                yield pd.DataFrame({"block": [r.block], "v": [r.v], "m": [m], "xs": [r.xs], "far": [reach(m, dist, m[place])],
                                    "near_d": [dist.ravel()], "near_m": [m[place].ravel()]})

    def asks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                x, far = _matrix(r, "xs", d), np.asarray(r.far)
                home = np.full(len(x), r.block, np.int64)
                yield from _sent(r.block, x, far, boxes.value, {"home": home, "place": np.arange(len(x)), "far": far}, d)

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Those within reach, and of one block no more than ``min_samples``."""
        for batch in batches:
            out: dict[str, list] = {"block": [], "place": [], "d": [], "near": []}
            for r in batch.itertuples(index=False):
                i, j, dist = _within(_matrix(r, "q_xs", d), _matrix(r, "xs", d), np.asarray(r.q_far))
                order = np.lexsort((dist, i))
                i, j, dist = i[order], j[order], dist[order]
                few = np.arange(len(i)) - np.searchsorted(i, i) < min_samples
                if few.any():
                    out["block"].append(r.q_home[0])
                    out["place"].append(np.asarray(r.q_place)[i[few]])
                    out["d"].append(dist[few])
                    out["near"].append(np.asarray(r.m)[j[few]])
            if out["block"]:
                yield pd.DataFrame(out)

    def cores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                m = np.asarray(r.m)
                place, dist, near = np.repeat(np.arange(len(m)), len(r.near_d) // len(m)), np.asarray(r.near_d), np.asarray(r.near_m)
                if getattr(r, "place", None) is not None:
                    place, dist, near = np.r_[place, r.place], np.r_[dist, r.d], np.r_[near, r.near]
                yield pd.DataFrame({"v": np.asarray(r.v), "m": m, "x": list(_matrix(r, "xs", d)), "block": r.block,
                                    "core": _core(m, place, dist, near, min_samples)})

    found = packed.mapInPandas(own, _OWN)
    if len(boxes.value["block"]) > 1:
        found = materialize(found, "own_distances")
        sent = found.mapInPandas(asks, "block int, q_home array<long>, q_place array<long>, q_far array<double>, q_xs array<double>")
        heard = sent.join(packed.select("block", "m", "xs"), "block").mapInPandas(
            answers, "block int, place array<long>, d array<double>, near array<long>")
        heard = heard.groupBy("block").agg(F.collect_list(F.struct("place", "d", "near")).alias("_r"))
        found = found.join(heard.select("block", *[F.flatten(f"_r.{c}").alias(c) for c in ("place", "d", "near")]), "block", "left")
    return found.mapInPandas(cores, "v long, m long, x array<double>, block int, core double")


def _sent(block: int, x: np.ndarray, bound: np.ndarray, boxes: dict, extra: dict, d: int, passed=None) -> Iterator[pd.DataFrame]:
    """For each other block, the points whose bound reaches into its box.
    ``passed(i)``: points that need not go to the i-th block."""
    out: dict[str, list] = {"block": [], **{f"q_{c}": [] for c in extra}, "q_xs": []}
    if len(x):
        near = np.flatnonzero((_box_gap(x.min(axis=0), x.max(axis=0), boxes["lo"], boxes["hi"]) <= bound.max()) & (boxes["block"] != block))
        for a in range(0, len(near), 256):
            ids = near[a:a + 256]
            hit = _to_boxes(x, boxes["lo"][ids], boxes["hi"][ids]) <= bound[:, None]
            for i in np.flatnonzero(hit.any(axis=0)):
                rows = hit[:, i] if passed is None else hit[:, i] & ~passed(ids[i])
                if rows.any():
                    out["block"].append(boxes["block"][ids[i]])
                    for c, values in extra.items():
                        out[f"q_{c}"].append(values[rows])
                    out["q_xs"].append(x[rows].ravel())
    if out["block"]:
        yield pd.DataFrame(out)


# --- spanning tree ----------------------------------------------------------

_EDGE = "comp long, w double, lo long, hi long, other long"


def _edge_frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["comp", "w", "lo", "hi", "other"])
    return frame.astype({"comp": "int64", "w": "float64", "lo": "Int64", "hi": "Int64", "other": "Int64"})


def _least_edges(best: dict[int, tuple], x, core, v, comp, y, core_y, v_y, comp_y, bound=None) -> None:
    """Least edge (by weight, then ids) of each component of the x to another
    component of the y, not above ``bound`` of the x; ``best`` keeps the lesser of it and what it has."""
    if not len(x):
        return
    squares, off = _squares(x, y)
    least = np.concatenate([np.where(comp[a:a + 512, None] == comp_y, np.inf, np.maximum(squares(slice(a, a + 512)), core_y * core_y)).min(axis=1)
                            for a in range(0, len(x), 512)])
    least = np.maximum(least, core * core)
    groups, group = np.unique(comp, return_inverse=True)
    known = np.array([best[c][0] if c in best else np.inf for c in groups.tolist()])
    limit = np.minimum.reduceat(least[np.argsort(group, kind="stable")], np.r_[0, np.cumsum(np.bincount(group))[:-1]]) + 2 * off
    limit = np.minimum(limit, known * known * (1 + 1e-12) + off)[group]
    if bound is not None:
        limit = np.minimum(limit, bound * bound * (1 + 1e-12) + off)
    live = np.flatnonzero((least <= limit * (1 + 1e-12)) & np.isfinite(least))  # only these rows can have a least edge
    for a in range(0, len(live), 512):
        part = live[a:a + 512]
        w = np.maximum(_distances(x[part], y), np.maximum(core[part, None], core_y[None, :]))
        w[comp[part, None] == comp_y[None, :]] = np.inf
        low = w.min(axis=1)
        for i, (at, c, weight) in enumerate(zip(part.tolist(), comp[part].tolist(), low.tolist(), strict=True)):
            if c in best and weight > best[c][0] or bound is not None and weight > bound[at]:
                continue
            mine = int(v[at])
            for j in np.flatnonzero(w[i] == weight):
                other = int(v_y[j])
                edge = (weight, min(mine, other), max(mine, other), int(comp_y[j]))
                if c not in best or edge < best[c]:
                    best[c] = edge


def _merged(links: DataFrame) -> DataFrame:
    """``comp, root`` from each component's link ``comp, other`` (its least edge):
    links form trees that end in two components linked to each other; the lesser
    of these is the root.  Up to SWEEP_EDGES links are followed in one task;
    beyond, pointers are doubled until they reach roots."""
    if links.count() <= SWEEP_EDGES:
        def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            up = {c: o for batch in batches for c, o in zip(batch["comp"].tolist(), batch["other"].tolist(), strict=True)}
            roots = {c: c for c, o in up.items() if up[o] == c and c < o}
            for c in up:
                path = []
                while c not in roots:
                    path.append(c)
                    c = up[c]
                roots.update(dict.fromkeys(path, roots[c]))
            if roots:
                yield pd.DataFrame({"comp": list(roots), "root": list(roots.values())})

        return links.coalesce(1).mapInPandas(follow, "comp long, root long")
    back = links.select(F.col("comp").alias("other"), F.col("other").alias("_back"))
    up = materialize(links.join(back, "other", "left").select(
        "comp", F.when((F.col("_back") == F.col("comp")) & (F.col("comp") < F.col("other")), F.col("comp")).otherwise(F.col("other")).alias("root")), "pointers")
    while True:
        above = up.select(F.col("comp").alias("root"), F.col("root").alias("_up"))
        up = materialize(up.join(above, "root").select("comp", F.col("_up").alias("root"), (F.col("_up") != F.col("root")).alias("moved")), "pointers")
        if not up.filter("moved").limit(1).count():
            return up.select("comp", "root")
        up = up.select("comp", "root")


def _local_tree(x: np.ndarray, core: np.ndarray, v: np.ndarray) -> list[tuple[float, int, int]]:
    """Minimum spanning tree of a block (Prim): (weight, place, place), ascending."""
    n = len(x)
    order = np.argsort(v)
    x, core = x[order], core[order]  # equal weights by ids, as everywhere
    whole = np.maximum(_distances(x, x), np.maximum(core[:, None], core)) if n <= WHOLE_ROWS else None
    best, via = np.full(n, np.inf), np.zeros(n, np.int64)
    edges, at, open_, reached = [], 0, np.ones(n, bool), np.full(n, np.inf)
    for _ in range(n - 1):
        open_[at], reached[at] = False, np.inf
        w = whole[at] if whole is not None else np.maximum(_distances(x[at:at + 1], x)[0], np.maximum(core, core[at]))
        # of two equal edges to one point, that from the lesser place comes first
        nearer = np.flatnonzero(((w < best) | ((w == best) & (via > at))) & open_)
        best[nearer], via[nearer], reached[nearer] = w[nearer], at, w[nearer]
        least = np.flatnonzero(reached == reached.min())
        at = int(least[0]) if len(least) == 1 else min(least.tolist(), key=lambda i: (min(i, via[i]), max(i, via[i])))
        edges.append((float(best[at]), int(min(at, via[at])), int(max(at, via[at]))))
    return [(w, int(order[a]), int(order[b])) for w, a, b in sorted(edges)]


def _sure_edges(x, core, v, out) -> tuple[np.ndarray, list[tuple[float, int, int]]]:
    """Edges of a block that are in the whole table's tree, and the components
    that they make (by least id).  ``out``: each point's distance to other blocks.

    Of the block's tree, an edge is the least one that leaves either component
    that it joins, within the block; it is the least one at all if one of the two
    is farther from all other blocks than the edge's weight.
    """
    n = len(x)
    grown, sure = list(range(n)), list(range(n))   # by all edges so far; by sure ones
    away = np.maximum(core, out).tolist()

    def root(up, i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    kept = []
    for w, a, b in _local_tree(x, core, v):
        p, q = root(grown, a), root(grown, b)
        if max(away[p], away[q]) > w:
            kept.append((w, int(min(v[a], v[b])), int(max(v[a], v[b]))))
            sure[root(sure, a)] = root(sure, b)
        grown[p] = q
        away[q] = min(away[p], away[q])
    roots = np.array([root(sure, i) for i in range(n)])
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, roots, v)
    return least[roots], kept


def spanning_tree(points: DataFrame, d: int) -> DataFrame:
    """``lo, hi, w``: the edges of the minimum spanning tree of mutual
    reachability.  ``points``: ``v, m, x, block, core``."""
    spark = points.sparkSession
    first = materialize(_packed(points, ["v", "core"]), "density_blocks")
    found = _directory(first, d)
    around = spark.sparkContext.broadcast(found)

    def locally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = around.value
        for batch in batches:
            for r in batch.itertuples(index=False):
                x, core, v = _matrix(r, "xs", d), np.asarray(r.core), np.asarray(r.v)
                near = b["block"] != r.block
                comp, kept = _sure_edges(x, core, v, _out(x, b["lo"][near], b["hi"][near]))
                yield pd.DataFrame({"block": [r.block], "v": [v], "core": [core], "xs": [r.xs], "start": [comp], "top": [core.max()],
                                    "w": [np.array([e[0] for e in kept], np.float64)], "lo": [np.array([e[1] for e in kept], np.int64)],
                                    "hi": [np.array([e[2] for e in kept], np.int64)]})

    # the blocks stay as they are: a component at the start is inside one block, rounds carry its present name only
    blocks = materialize(first.mapInPandas(locally, "block int, v array<long>, core array<double>, xs array<double>, start array<long>, "
                                           "top double, w array<double>, lo array<long>, hi array<long>"), "sure_edges")
    parts = [blocks.select(F.explode(F.arrays_zip("lo", "hi", "w")).alias("e")).select("e.*")]
    tops = dict(blocks.select("block", "top").collect())
    state = materialize(blocks.select("block", F.explode(F.array_distinct("start")).alias("start")).withColumn("comp", F.col("start")), "components")
    blocks = blocks.select("block", "v", "core", "xs", "start")

    def named(marks: DataFrame, columns: list[str]) -> DataFrame:
        """The blocks with the names, by ``start``, of their components."""
        row = F.collect_list(F.struct("start", *columns))
        marks = marks.groupBy("block").agg(row.alias("_r")).select("block", *[F.col(f"_r.{c}").alias(f"of_{c}") for c in ("start", *columns)])
        return blocks.join(marks, "block")

    def names_of(r, *columns: str) -> list[np.ndarray]:
        starts = np.asarray(r.of_start)
        order = np.argsort(starts)
        at = order[np.searchsorted(starts[order], np.asarray(r.start))]
        return [np.asarray(getattr(r, f"of_{c}"))[at] for c in columns]

    while True:
        info = {r[0]: r[1:] for r in state.groupBy("block").agg(F.min("comp"), F.max("comp")).collect()}
        if len({c for ends in info.values() for c in ends}) <= 1:
            tree = parts[0]
            for more in parts[1:]:
                tree = tree.unionByName(more)
            return tree
        ends = [info[b] for b in found["block"].tolist()]
        found = {**found, "pure": np.array([lo == hi for lo, hi in ends]), "comp": np.array([lo if lo == hi else -1 for lo, hi in ends], np.int64),
                 "core": np.array([tops[b] for b in found["block"].tolist()])}
        boxes = spark.sparkContext.broadcast(found)

        def inside(batches: Iterator[pd.DataFrame], boxes=boxes) -> Iterator[pd.DataFrame]:
            """Least edges within a block; a block of one component gives a bound
            instead: everything in the nearest other block is that near."""
            b = boxes.value
            for batch in batches:
                rows: list[tuple] = []
                for r in batch.itertuples(index=False):
                    x, core, v, (comp,) = _matrix(r, "xs", d), np.asarray(r.core), np.asarray(r.v), names_of(r, "comp")
                    if comp.min() != comp.max():
                        best: dict[int, tuple] = {}
                        _least_edges(best, x, core, v, comp, x, core, v, comp)
                        rows += [(c, *e) for c, e in best.items()]
                        continue
                    lo, hi, c = x.min(axis=0), x.max(axis=0), int(comp[0])
                    unlike = ~(b["pure"] & (b["comp"] == c)) & (b["block"] != r.block)
                    wide = np.maximum(np.abs(b["hi"] - lo), np.abs(hi - b["lo"]))
                    bound = np.maximum(np.maximum(np.sqrt((wide * wide).sum(axis=1)), b["core"]), core.max()) * (1 + 1e-12)
                    if unlike.any():
                        rows.append((c, float(bound[unlike].min()), None, None, None))
                yield _edge_frame(rows)

        own = materialize(named(state, ["comp"]).mapInPandas(inside, _EDGE), "own_edges")
        candidates = own
        if len(found["block"]) > 1:
            bounds = own.groupBy("comp").agg(F.min("w").alias("bound"))
            marks = state.join(bounds, "comp", "left").select("block", "start", "comp", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
            bounded = named(materialize(marks, "component_bounds"), ["comp", "bound"])

            def asks(batches: Iterator[pd.DataFrame], boxes=boxes) -> Iterator[pd.DataFrame]:
                b = boxes.value
                for batch in batches:
                    for r in batch.itertuples(index=False):
                        x, core, v, (comp, bound) = _matrix(r, "xs", d), np.asarray(r.core), np.asarray(r.v), names_of(r, "comp", "bound")
                        live = core <= bound
                        x, core, comp, bound, v = x[live], core[live], comp[live], bound[live], v[live]
                        yield from _sent(r.block, x, bound, b, {"v": v, "core": core, "comp": comp, "bound": bound}, d,
                                         lambda i, comp=comp: (comp == b["comp"][i]) & b["pure"][i])

            def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    best: dict[int, tuple] = {}
                    for r in batch.itertuples(index=False):
                        _least_edges(best, _matrix(r, "q_xs", d), np.asarray(r.q_core), np.asarray(r.q_v), np.asarray(r.q_comp),
                                     _matrix(r, "xs", d), np.asarray(r.core), np.asarray(r.v), names_of(r, "comp")[0], np.asarray(r.q_bound))
                    yield _edge_frame([(c, *e) for c, e in best.items()])

            sent = bounded.mapInPandas(asks, "block int, q_v array<long>, q_core array<double>, q_comp array<long>, q_bound array<double>, q_xs array<double>")
            candidates = own.unionByName(sent.join(bounded, "block").mapInPandas(answers, _EDGE))
        chosen = candidates.filter("lo is not null").groupBy("comp").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e"))
        chosen = materialize(chosen.select("comp", "e.*"), "chosen_edges")
        parts.append(chosen.select("lo", "hi", "w").distinct())
        roots = _merged(chosen.select("comp", "other"))
        state = materialize(state.join(roots, "comp").select("block", "start", F.col("root").alias("comp")), "components")


# --- hierarchy --------------------------------------------------------------

_STATE = "label long, size long, cluster string, level_sum double, parts_worth double"
_EVENT = f"kind string, {_STATE}, into long, level double, parent string, chosen boolean, birth double"
_EVENT_TYPES = {"label": "Int64", "size": "Int64", "into": "Int64", "kind": object, "cluster": object, "parent": object, "chosen": object,
                "level_sum": float, "parts_worth": float, "level": float, "birth": float}


class _Sweep:
    """Union-find over component summaries, edges by ascending weight."""

    def __init__(self, min_cluster_size: int):
        self.min_size, self.parent, self.state, self.rows = min_cluster_size, {}, {}, []
        self.members: dict[int, list[int]] = {}  # labels in a component that is no cluster yet

    def add(self, label: int, size: int, cluster, level_sum: float, parts_worth: float) -> None:
        if label not in self.parent:
            self.parent[label] = label
            self.state[label] = [size, cluster, level_sum, parts_worth]
            self.members[label] = [label]

    def root(self, label: int) -> int:
        up = self.parent
        while up[label] != label:
            up[label] = up[up[label]]
            label = up[label]
        return label

    def row(self, *values) -> None:
        """In the order of _EVENT."""
        self.rows.append(values)

    def written(self) -> Iterator[pd.DataFrame]:
        """The rows so far, SWEEP_ROWS at a time; they are let go."""
        for at in range(0, len(self.rows), SWEEP_ROWS):
            yield pd.DataFrame(self.rows[at:at + SWEEP_ROWS], columns=[c.split()[0] for c in _EVENT.split(", ")]).astype(_EVENT_TYPES)
        self.rows.clear()

    def leave(self, root: int, cluster: str, level: float) -> None:
        self.rows += [("left", label, None, cluster, None, None, None, level, None, None, None) for label in self.members.pop(root)]

    def close(self, s: list, level: float, parent: str | None) -> float:
        """A cluster ends (from below) at ``level``: keep it, or what it is made of."""
        size, cluster, level_sum, parts = s
        own = level_sum - size * level
        chosen = parent is not None and own >= parts
        self.row("cluster", None, size, cluster, None, None, None, None, parent, chosen, level)
        return own if own >= parts else parts

    def merge(self, name: str, lo: int, hi: int, w: float) -> None:
        a, b = self.root(lo), self.root(hi)
        level = 1.0 / max(w, NEAREST)
        s, t = self.state[a], self.state[b]
        if (s[0], b) < (t[0], a):  # a is the larger; of equal ones, that with the lesser label
            a, b, s, t = b, a, t, s
        size = s[0] + t[0]
        if t[1] is not None:  # both are clusters
            worth = self.close(s, level, name) + self.close(t, level, name)
            merged = [size, name, size * level, worth]
        elif s[1] is not None:  # the small one leaves the cluster here
            self.leave(b, s[1], level)
            merged = [size, s[1], s[2] + t[0] * level, s[3]]
        elif size >= self.min_size:
            for root in (a, b):
                self.leave(root, name, level)
            merged = [size, name, size * level, 0.0]
        else:
            self.members[a] += self.members.pop(b)
            merged = [size, None, 0.0, 0.0]
        self.parent[b] = a
        self.state[a] = merged
        del self.state[b]  # only roots are read


def hierarchy(points: DataFrame, tree: DataFrame, min_cluster_size: int) -> tuple[DataFrame, DataFrame]:
    """(``v, cluster, level``: the cluster that each point leaves and where;
    ``cluster, parent, chosen, birth``) from the spanning tree's edges."""
    start = F.col("m") >= min_cluster_size  # that many copies are a cluster by themselves
    level = 1.0 / F.greatest("core", F.lit(NEAREST))
    name = F.when(start, F.concat(F.lit("v"), F.col("v")))
    states = points.select(F.col("v").alias("label"), F.col("m").alias("size"), name.alias("cluster"),
                           F.when(start, F.col("m") * level).otherwise(0.0).alias("level_sum"), F.lit(0.0).alias("parts_worth"))
    left = points.select("v", F.col("v").alias("label"), name.alias("cluster"), F.when(start, level).alias("level"))
    left = materialize(left, "density_left")
    states = materialize(states, "density_states")
    edges = materialize(consecutive_ids(tree.select("lo", "hi", "w"), ["w", "lo", "hi"], "pos").select(
        "pos", "w", F.col("lo").alias("a"), F.col("hi").alias("b")), "density_edges")
    n = edges.count()
    clusters = []
    for first in range(0, max(n, 1), SWEEP_EDGES):
        last = first + SWEEP_EDGES >= n
        part = edges.filter(F.col("pos").between(first, first + SWEEP_EDGES - 1))
        side = lambda c: states.select(*[F.col(k).alias(f"{c}_{k}") for k in ("label", "size", "cluster", "level_sum", "parts_worth")])
        part = part.join(side("a"), F.col("a") == F.col("a_label")).join(side("b"), F.col("b") == F.col("b_label"))
        # one bounded group: SWEEP_EDGES edges with the summaries of their ends

        def sweep(batches: Iterator[pd.DataFrame], last=last) -> Iterator[pd.DataFrame]:
            run = _Sweep(min_cluster_size)
            parts = []
            for batch in batches:
                parts.append(batch[["pos", "w", "a", "b"]])
                for c in "ab":
                    side_of = [batch[k].tolist() for k in (c, f"{c}_size", f"{c}_cluster", f"{c}_level_sum", f"{c}_parts_worth")]
                    for summary in zip(*side_of, strict=True):
                        run.add(*summary)
            if not parts:
                return
            rows = pd.concat(parts).sort_values("pos", kind="stable")
            parts.clear()
            for at in range(0, len(rows), SWEEP_ROWS):
                some = rows[at:at + SWEEP_ROWS]
                for pos, w, a, b in zip(*(some[k].tolist() for k in ("pos", "w", "a", "b")), strict=True):
                    run.merge(f"e{pos}", a, b, w)
                yield from run.written()
            for label in run.state if last else run.parent:  # after the last sweep only clusters count
                top = run.root(label)
                size, cluster, level_sum, worth = run.state[top]
                if last:
                    if cluster is not None:  # the cluster of everything is never chosen
                        run.close(run.state[top], 0.0, None)
                elif top == label:
                    run.row("state", label, size, cluster, level_sum, worth, None, None, None, None, None)
                else:
                    run.row("moved", label, None, None, None, None, top, None, None, None, None)
                if len(run.rows) >= SWEEP_ROWS:
                    yield from run.written()
            yield from run.written()

        done = materialize(part.repartition(1).mapInPandas(sweep, _EVENT), "density_sweep")
        events = lambda kind: done.filter(F.col("kind") == kind)
        clusters.append(events("cluster").select("cluster", "parent", "chosen", "birth"))
        gone = events("left").select("label", F.col("cluster").alias("_c"), F.col("level").alias("_l"))
        moved = events("moved").select("label", "into")
        placed = left.join(gone, "label", "left").withColumn("cluster", F.coalesce("cluster", "_c")).withColumn("level", F.coalesce("level", "_l"))
        placed = placed.join(moved, "label", "left").select("v", F.coalesce("into", "label").alias("label"), "cluster", "level")
        left = materialize(placed, "density_left")
        if not last:
            seen = events("state").select("label").unionByName(moved.select("label"))
            states = materialize(states.join(seen, "label", "left_anti").unionByName(
                events("state").select("label", "size", "cluster", "level_sum", "parts_worth")), "density_states")
            rest = edges.filter(F.col("pos") >= first + SWEEP_EDGES)
            for c in "ab":
                rest = rest.join(moved.select(F.col("label").alias(c), F.col("into").alias("_to")), c, "left").withColumn(
                    c, F.coalesce("_to", c)).drop("_to")
            edges = materialize(rest, "density_edges")
    out = clusters[0]
    for more in clusters[1:]:
        out = out.unionByName(more)
    return left.select("v", "cluster", "level"), out


def _topmost(clusters: DataFrame) -> DataFrame:
    """``cluster, top``: the topmost chosen one among a cluster and its ancestors
    (null without).  Doubles the distance to the ancestor in each round."""
    now = materialize(clusters.select("cluster", F.col("parent").alias("up"), F.when(F.col("chosen"), F.col("cluster")).alias("top")), "cluster_tops")
    while now.filter("up is not null").limit(1).count():
        above = now.select(F.col("cluster").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"))
        now = materialize(now.join(above, "up", "left").select(
            "cluster", F.col("_up").alias("up"), F.coalesce("_top", "top").alias("top")), "cluster_tops")
    return now.select("cluster", "top")


def density_clusters(df: DataFrame, vec: str = "reduced", min_samples: int = L.MIN_SAMPLES,
                     min_cluster_size: int = L.MIN_CLUSTER_SIZE, id_col: str = "vec_id", out: str = "topic") -> DataFrame:
    """M2: one row per row of ``df``: id, ``topic`` and ``strength``.

    ``topic`` numbers the chosen clusters 0, 1, ... by size (largest first, ties
    by least id); -1 is noise.  ``strength`` is the level at which a vector leaves its
    cluster over the highest level in it, 1 for the densest members, 0 for noise.
    Vectors that are null, empty or hold a null or non-finite number are noise.
    If all vectors form one cluster without a split, all are noise.  Rows may repeat
    an id; an empty table gives an empty result.
    """
    fit = fit_density(df, vec, min_samples, min_cluster_size, id_col, out)
    x = F.col(vec).cast("array<double>")
    members = fit.select("x", F.col(out).alias("_topic"), "strength")
    return df.select(id_col, x.alias("_x")).join(members, F.col("_x") == F.col("x"), "left").select(
        id_col, F.coalesce("_topic", F.lit(-1)).alias(out), F.coalesce("strength", F.lit(0.0)).alias("strength"))


def fit_density(df: DataFrame, vec: str = "reduced", min_samples: int = L.MIN_SAMPLES,
                min_cluster_size: int = L.MIN_CLUSTER_SIZE, id_col: str = "vec_id", out: str = "topic") -> DataFrame:
    """The fitted clusters as a table of distinct vectors that can be stored:
    ``v, m, x, block, core, topic, strength, level_top, birth``.  ``level_top`` is the
    highest level in the topic, ``birth`` the level at which the topic begins."""
    points, n, d = _points(df, vec, id_col)
    if not n:
        return points.select("v", "m", "x", "block", F.lit(0.0).alias("core"), F.lit(-1).alias(out), F.lit(0.0).alias("strength"),
                             F.lit(None).cast("double").alias("level_top"), F.lit(None).cast("double").alias("birth"))
    points = materialize(core_distances(points, min_samples, n, d), "density_points")
    left, clusters = hierarchy(points, spanning_tree(points, d), min_cluster_size)
    clusters = materialize(clusters, "clusters")
    tops = _topmost(clusters)
    member = points.join(left, "v").join(tops, "cluster", "left")
    births = clusters.select(F.col("cluster").alias("top"), "birth")
    sizes = member.filter("top is not null").groupBy("top").agg(
        F.sum("m").alias("_size"), F.min("v").alias("_least"), F.max("level").alias("level_top"))
    ranked = consecutive_ids(sizes.join(births, "top"), [F.col("_size").desc(), F.col("_least")], out).withColumn(out, F.col(out).cast("int"))
    member = member.join(ranked.select("top", out, "level_top", "birth"), "top", "left")
    strength = F.coalesce(F.col("level") / F.col("level_top"), F.lit(0.0))
    return member.select("v", "m", "x", "block", "core", F.coalesce(out, F.lit(-1)).alias(out), strength.alias("strength"), "level_top", "birth")


# --- membership of unseen rows ----------------------------------------------

_HITS = "v long, x array<double>, near array<struct<d: double, m: long, core: double, topic: int, birth: double, level_top: double>>"


def attach_to_clusters(df: DataFrame, fit: DataFrame, vec: str = "reduced", min_samples: int = L.MIN_SAMPLES,
                       id_col: str = "vec_id", out: str = "topic") -> DataFrame:
    """M3: one row per row of ``df``: id, ``topic`` and ``strength`` by a fitted
    table (:func:`fit_density`), which stays as it is.

    A row's core distance is taken among the fitted vectors.  It joins the topic of
    the fitted vector of least mutual reachability (ties to nearer ones), if it is
    reached above the level at which that topic begins; else it is noise (-1).
    ``strength`` is its level over the topic's highest, at most 1.  Vectors that are null,
    empty or hold a null or non-finite number, and all rows if nothing was fitted,
    are noise.
    """
    fit = materialize(fit.withColumnRenamed(out, "topic"), "density_fit")
    first = fit.select(F.size("x")).first()
    x = F.col(vec).cast("array<double>")
    rows = df.select(id_col, x.alias("_x"))
    if first is None:
        return rows.select(id_col, F.lit(-1).alias(out), F.lit(0.0).alias("strength"))
    d = first[0]
    carried = ["v", "m", "core", "topic", "birth", "level_top"]
    packed = materialize(_packed(fit.select("block", "x", *carried), carried), "density_blocks")
    boxes = fit.sparkSession.sparkContext.broadcast(_directory(packed, d))
    whole = F.col("_x").isNotNull() & (F.size("_x") == d) & ~F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    asked = rows.filter(whole).select(F.col("_x").alias("x")).distinct().withColumn("v", F.xxhash64("x"))

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = boxes.value
        for batch in batches:
            points = _rows_of(batch, "x")
            at = [_to_boxes(points[a:a + 64], b["lo"], b["hi"]).argmin(axis=1) for a in range(0, len(points), 64)]
            yield batch.assign(block=b["block"][np.concatenate(at)].astype(np.int32) if at else [])

    def hits(r, points: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
        dist, place = _nearest(points, _matrix(r, "xs", d), min_samples, False)
        fields = {c: np.asarray(getattr(r, c), object) for c in carried if c != "v"}
        return dist, [[{"d": float(e), **{c: fields[c][p] for c in fields}} for e, p in zip(ds, ps, strict=True)]
                      for ds, ps in zip(dist, place, strict=True)]

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                points = _matrix(r, "q_xs", d)
                yield pd.DataFrame({"v": np.asarray(r.q_v), "x": list(points), "near": hits(r, points)[1]})

    def asks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                points = _matrix(r, "q_xs", d)
                dist, _ = hits(r, points)
                far = dist[:, -1] if dist.shape[1] == min_samples else np.full(len(points), np.inf)
                yield from _sent(r.block, points, far, boxes.value, {"v": np.asarray(r.q_v)}, d)

    homes = asked.mapInPandas(home, "x array<double>, v long, block int")
    bundles = _packed(homes.select("block", "v", "x"), ["v"]).select("block", F.col("v").alias("q_v"), F.col("xs").alias("q_xs"))
    met = materialize(bundles, "density_asked").join(packed, "block")
    near = met.mapInPandas(answers, _HITS)
    if len(boxes.value["block"]) > 1:
        more = met.mapInPandas(asks, "block int, q_v array<long>, q_xs array<double>").join(packed, "block")
        near = near.unionByName(more.mapInPandas(answers, _HITS))
    lists = near.groupBy("v", "x").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    core = F.aggregate("near", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("core")),
                       lambda s, e: F.when(s["seen"] >= min_samples, s).otherwise(
                           F.struct((s["seen"] + e["m"]).alias("seen"), e["d"].alias("core"))))["core"]
    lists = lists.withColumn("_core", core)
    best = F.array_min(F.transform(F.filter("near", lambda e: e["d"] <= F.col("_core")), lambda e: F.struct(
        F.greatest(e["d"], e["core"], F.col("_core")).alias("w"), e["d"].alias("d"), e["topic"].alias("topic"),
        e["birth"].alias("birth"), e["level_top"].alias("level_top"))))
    lists = lists.select("x", best.alias("b")).withColumn("level", 1.0 / F.greatest("b.w", F.lit(NEAREST)))
    joins = (F.col("b.topic") >= 0) & (F.col("level") >= F.col("b.birth"))
    found = lists.select("x", F.when(joins, F.col("b.topic")).otherwise(-1).alias("_topic"),
                         F.when(joins, F.least("level", "b.level_top") / F.col("b.level_top")).otherwise(0.0).alias("_strength"))
    return rows.join(found, F.col("_x") == F.col("x"), "left").select(
        id_col, F.coalesce("_topic", F.lit(-1)).alias(out), F.coalesce("_strength", F.lit(0.0)).alias("strength"))
