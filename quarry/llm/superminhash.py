"""Word shingles and SuperMinHash signatures of a chunk of texts, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE = 5
ROWS, BANDS = 5, 40      # a pair at similarity 0.75 misses every band with probability 2e-5
POSITIONS = ROWS * BANDS
TRACED = 3               # levels whose permutations are traced back instead of stored

_u = np.uint64
_ODD = _u(6364136223846793005)
_INVERSE = _u(pow(6364136223846793005, -1, 1 << 64))
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * _u(2) + _u(1)
_PLACE = np.random.default_rng(20240502).integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) * _u(2) + _u(1)
#: A-Z lower-cased; white space (0x20, 0x09-0x0D) as a space.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 32 or 9 <= c <= 13 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _u(30))) * _u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _u(27))) * _u(0x94D049BB133111EB)
    return x ^ (x >> _u(31))


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles: five words in a
    row; of fewer words, all of them; without words, none."""
    n = len(texts)
    data = b"\x20".join(t or b"" for t in texts).translate(_LOWER)
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return [np.zeros(0, np.uint64)] * n
    ends_of = np.cumsum([len(t or b"") + 1 for t in texts])
    word = raw != 32
    starts = np.flatnonzero(word & np.concatenate([[True], ~word[:-1]]))
    stops = np.flatnonzero(word & np.concatenate([~word[1:], [True]])) + 1
    # hash of a word: sum of byte values times powers, moved back to power 0
    power = np.full(len(raw) + 1, _ODD)
    power[0] = _u(1)
    power = np.multiply.accumulate(power)
    sums = np.concatenate([[_u(0)], np.cumsum(_BYTE[raw] * power[:-1])])
    back = np.full(len(raw) + 1, _INVERSE)
    back[0] = _u(1)
    back = np.multiply.accumulate(back)
    words = mix((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    first = np.searchsorted(starts, np.concatenate([[0], ends_of[:-1]]))
    last = np.append(first[1:], len(starts))
    if len(words) >= SHINGLE:
        m = len(words) - SHINGLE + 1
        total = words[:m] * _PLACE[0]
        for k in range(1, SHINGLE):
            total = total + words[k:k + m] * _PLACE[k]
        shingles = mix(total)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(shingles[a:b - SHINGLE + 1]))
        elif b > a:
            short = (words[a:b] * _PLACE[:b - a]).sum() ^ _u(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each set: sets x POSITIONS.

    Each element draws, level by level, the next place of its own random
    permutation and the value level + fraction for it; a place keeps its least
    value.  A set stops at the level from which no later draw can be least.
    All sets of the chunk go through a level together.
    """
    n, m = len(sets), POSITIONS
    high = np.iinfo(np.uint64).max
    sig = np.full(n * m, high, np.uint64)
    sizes = np.array([len(s) for s in sets])
    items = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    drawn: list[np.ndarray] = []
    perm = None
    for level in range(m):
        if not len(items):
            break
        bits = mix(items + np.array([level + 1], np.uint64) * _PLACE[0])
        pick = level + ((bits >> _u(40)) * _u(m - level) >> _u(24)).astype(np.int64)
        if perm is None and level == TRACED:
            perm = np.tile(np.arange(m, dtype=np.uint8), (len(items), 1))
            lanes = np.arange(len(items))
            for t, k in enumerate(drawn):
                perm[lanes, t], perm[lanes, k] = perm[lanes, k], perm[lanes, t].copy()
        if perm is None:
            place = pick
            for t in range(level - 1, -1, -1):
                place = np.where(place == drawn[t], t, np.where(place == t, drawn[t], place))
            drawn.append(pick)
        else:
            lanes = np.arange(len(items))
            place = perm[lanes, pick]
            perm[lanes, pick] = perm[:, level]
            perm[:, level] = place
            place = place.astype(np.int64)
        value = (_u(level) << _u(40)) | (bits & _u((1 << 40) - 1))
        np.minimum.at(sig, owner * m + place, value)
        if level + 1 < m:
            open_sets = sig.reshape(n, m).max(axis=1) >= _u((level + 1) << 40)
            stay = open_sets[owner]
            if not stay.all():
                items, owner = items[stay], owner[stay]
                drawn = [k[stay] for k in drawn]
                perm = perm[stay] if perm is not None else None
    return sig.reshape(n, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of ROWS positions; bands never share keys
    but by chance."""
    out = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        out = mix(out + sig[:, r::ROWS] * _PLACE[r])
    return mix(out + np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACE[SHINGLE]).view(np.int64)


def set_key(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()
