"""Sets of hashed word shingles, and their count vectors."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

GROUP_BITS = 16  # groups of a count vector are the upper bits of a shingle's hash
LEAST_GROUPS, MOST_GROUPS = 64, 2048  # coordinates of a point in a tree, which joins neighbouring groups
_CHUNK = 1 << 19  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SMALL = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, _SMALL)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of UTF-8 text; A-Z count as a-z.

    A word's hash is a polynomial in its bytes, taken from running sums.
    """
    hashes, firsts, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + _CHUNK)
        while stop < len(data) and not _SPACE[data[stop - 1]]:  # up to the end of a word
            more = np.flatnonzero(_SPACE[data[stop : stop + _CHUNK]])
            stop = stop + int(more[0]) + 1 if len(more) else min(len(data), stop + _CHUNK)
        part = data[at:stop]
        inside = np.empty(len(part) + 2, bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = ~_SPACE[part]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[0::2], edges[1::2]
        size = max(2 * _CHUNK, 1 << len(part).bit_length())
        power, inverse = _powers(size)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * power[: len(part)], out=sums[1:])
        hashes.append(mix((sums[end] - sums[start]) * inverse[start]))
        firsts.append(start + at)
        at = stop
    empty = np.zeros(0, np.int64)
    return np.concatenate(hashes or [empty.astype(np.uint64)]), np.concatenate(firsts or [empty])


def shingle_sets(texts: list[str], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    hashes, first = word_hashes(data)
    bounds = np.concatenate([[0], np.searchsorted(first, ends)])
    rolled, step = np.zeros(len(hashes), np.uint64), np.uint64(_BASE)
    if len(hashes) >= words:
        last = len(hashes) - words + 1
        whole = hashes[:last].copy()
        for k in range(1, words):
            whole = whole * step + hashes[k : k + last]
        rolled[:last] = mix(whole)
    sets = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= words:
            own = np.sort(rolled[low : high - words + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif high > low:
            value = np.array([high - low], np.uint64)
            for h in hashes[low:high]:
                value = value * step + h
            own = mix(value)
        else:
            own = np.zeros(0, np.uint64)
        sets.append(own)
    return sets


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit values that stand for a set."""
    pair = [mix(own ^ np.uint64(seed)).sum(dtype=np.uint64) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return tuple(int(p.astype(np.int64)) for p in pair)


def counts(own: np.ndarray) -> bytes:
    """A set's count vector over 65,536 groups, written as the steps from one shingle's group to the next.

    A group is the upper 16 bits of a shingle's hash.  A step takes a byte, and one of 255 more for every
    255 that it is long.
    """
    steps = np.diff((own >> np.uint64(64 - GROUP_BITS)).astype(np.int64), prepend=0)
    ends = np.cumsum(steps // 255 + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 255, np.uint8)
    out[ends] = steps % 255
    return out.tobytes()


def groups(packed: bytes) -> np.ndarray:
    """The groups of a set's shingles in order, each as often as it counts."""
    steps = np.frombuffer(packed, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255].astype(np.uint16)


def points(vectors: list[np.ndarray]) -> np.ndarray:
    """Count vectors as rows of coordinates: groups are joined until the smallest set has two to four shingles to each."""
    smallest = min(map(len, vectors))
    bits = min(MOST_GROUPS, max(LEAST_GROUPS, 1 << (smallest // 4).bit_length())).bit_length() - 1
    out = np.empty((len(vectors), 1 << bits), np.int32)
    for row, own in zip(out, vectors):
        row[:] = np.bincount(own >> (GROUP_BITS - bits), minlength=1 << bits)
    return out


class Minima:
    """Sums of coordinate minima of count vectors over all groups, of one vector with many at a time."""

    def __init__(self, vectors: list[np.ndarray]):
        self.groups = vectors
        self.turns = []  # how often a group has come before: a shared count c is met by turns 0 to c - 1
        for own in self.groups:
            at = np.arange(len(own))
            new = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
            self.turns.append((at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.int32))

    def with_others(self, one: int, others: np.ndarray) -> np.ndarray:
        """The sum for each pair of ``one`` and the ``others``, none of which is empty."""
        held = np.bincount(self.groups[one], minlength=1 << GROUP_BITS).astype(np.int32)
        groups = np.concatenate([self.groups[k] for k in others])
        turns = np.concatenate([self.turns[k] for k in others])
        starts = np.cumsum([0, *[len(self.groups[k]) for k in others[:-1]]])
        return np.add.reduceat(turns < held[groups], starts, dtype=np.int64)
