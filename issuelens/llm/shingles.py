"""Word shingle sets as sorted 64-bit hashes, and their block signatures.

Everything works on the UTF-8 bytes of many texts at once; only the sort of
each text's hashes is a call per text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
# Seeds of the byte values and multipliers (odd, from a fixed generator).
_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) | _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _RNG.integers(1, 2 ** 63, 64, dtype=np.uint64) | _U(1)
_BASE = int(_RNG.integers(1, 2 ** 63)) | 1
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@lru_cache(maxsize=2)
def _powers(base: int, bits: int) -> np.ndarray:
    p = np.full(1 << bits, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text, and the offsets of the texts in them."""
    n = len(at) - 1
    if not raw.size:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    solid = ~_WHITE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = at[1:-1]
    edges = edges[edges < raw.size]
    first[edges] = solid[edges]
    after = solid.copy()  # last byte of a word
    after[:-1] &= ~solid[1:]
    inner = edges[edges > 0]
    after[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(after) + 1
    bits = max(16, int(raw.size).bit_length())
    up, down = _powers(_BASE, bits), _powers(_BACK, bits)
    sums = np.zeros(raw.size + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:raw.size], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, at)


def shingle_sets(raw: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each text, and the offsets of the
    texts in them; fewer words than ``k`` are one shingle, no word is none."""
    w, wat = word_hashes(raw, at)
    n = len(at) - 1
    counts = np.diff(wat)
    many = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    off = np.zeros(n + 1, np.int64)
    np.cumsum(many, out=off[1:])
    h = np.zeros(off[-1], np.uint64)
    if not h.size:
        return h, off
    owner = np.repeat(np.arange(n), many)
    begin = wat[owner] + np.arange(h.size) - off[owner]
    padded = np.concatenate([w, np.zeros(k, np.uint64)])
    length = np.minimum(counts, k)[owner]
    for j in range(k):
        part = padded[begin + j] * _PLACE[j]
        h += part if j == 0 else np.where(j < length, part, _U(0))
    h = mix(h + length.astype(np.uint64))
    bounds = off.tolist()
    for a, b in zip(bounds, bounds[1:]):
        if b - a > 1:
            h[a:b].sort()
    fresh = np.ones(h.size, bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(owner[fresh], minlength=n), out=out[1:])
    return h[fresh], out


def segment_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums (modulo 2 ** 64) of the segments given by offsets; an empty one is 0."""
    total = np.zeros(values.size + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def set_ids(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One 64-bit id for each set: equal sets have equal ids."""
    return mix(segment_sums(mix(h ^ _PLACE[20]), off) + np.diff(off).astype(np.uint64) * _PLACE[21])


class Bands:
    """Size bands and their numbers of hash blocks for a similarity of ``percent``.

    Sets A and B are similar enough exactly if ``|A ^ B| * up <= (|A| + |B|) * down``
    with ``up = 100 + percent`` and ``down = 100 - percent``.  A band has one block
    more than two of its sets may differ in, and spare ones for empty blocks.
    """

    def __init__(self, percent: int, growth: float = 1.5):
        self.percent, self.growth = percent, growth
        self.up, self.down = 100 + percent, 100 - percent
        n = 1
        while self.differ(n) == 0:
            n += 1
        self.least = n  # smaller sets are similar only to themselves
        self.edges, self.blocks, self.spare = [n], [], []

    def partner(self, n: int) -> int:
        """Largest size that a set of ``n`` can be similar to."""
        return n * 100 // self.percent

    def differ(self, n: int) -> int:
        return (n + self.partner(n)) * self.down // self.up

    def upto(self, n: int) -> None:
        while self.edges[-1] <= n:
            low = self.edges[-1]
            high = max(low + 1, int(low * self.growth))
            d = self.differ(high - 1)
            spare = 1
            while True:
                p = d + 1 + spare
                empty = p * np.exp(-low / p)
                if spare >= low or spare >= empty + 3 * np.sqrt(empty):
                    break  # small sets: what fails is signed again
                spare += 1
            self.edges.append(high)
            self.blocks.append(d + 1 + spare)
            self.spare.append(spare)

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, band) pairs in which sets are signed: their own band, and the one
        below where a smaller partner may be."""
        if sizes.size:
            self.upto(int(sizes.max()))
        edges = np.array(self.edges)
        band = np.searchsorted(edges, sizes, side="right") - 1
        own = np.flatnonzero(band >= 0)
        smallest = -(-sizes * self.percent // 100)
        below = np.flatnonzero((band >= 1) & (smallest < edges[np.maximum(band, 0)]))
        return np.concatenate([own, below]), np.concatenate([band[own], band[below] - 1])


def signatures(h: np.ndarray, off: np.ndarray, bands: Bands, tries: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature) rows.  Two similar sets share one at least.

    The hash range is cut into the band's blocks; each block's hashes make one
    signature.  As two similar sets differ in fewer hashes than there are
    blocks, some block is equal in both.  That block could be an empty one, so
    a set with more empty blocks than the band has to spare is also signed
    under another cut, and after some cuts its empty blocks are signed too.
    """
    which, band = bands.of(np.diff(off))
    sets, sigs = [], []
    for attempt in range(tries):
        if not which.size:
            break
        last = attempt == tries - 1
        blocks = np.array(bands.blocks)[band]
        size = (off[which + 1] - off[which])
        start = np.zeros(which.size + 1, np.int64)
        np.cumsum(size, out=start[1:])
        owner = np.repeat(np.arange(which.size), size)
        x = h[np.arange(start[-1]) - start[owner] + off[which][owner]]
        if attempt:
            x = mix(x + _PLACE[30 + attempt])
        base = np.zeros(which.size + 1, np.int64)
        np.cumsum(blocks, out=base[1:])
        block = ((x >> _U(32)) * blocks[owner].astype(np.uint64) >> _U(32)).astype(np.int64)
        cell = base[owner] + block
        if attempt:
            order = np.argsort(cell, kind="stable")
            cell, x = cell[order], x[order]
        new = np.ones(cell.size, bool)
        new[1:] = cell[1:] != cell[:-1]
        at = np.flatnonzero(new)
        sums = np.add.reduceat(mix(x ^ _PLACE[40]), at) if at.size else np.zeros(0, np.uint64)
        cells = cell[at]
        who = np.searchsorted(base, cells, side="right") - 1
        filled = np.bincount(who, minlength=which.size)
        failed = blocks - filled > np.array(bands.spare)[band]
        if last and failed.any():
            bare = np.setdiff1d(np.arange(base[-1]), cells)
            bare = bare[failed[np.searchsorted(base, bare, side="right") - 1]]
            cells, sums = np.concatenate([cells, bare]), np.concatenate([sums, np.zeros(bare.size, np.uint64)])
            who = np.searchsorted(base, cells, side="right") - 1
        tag = (cells - base[who]).astype(np.uint64) * _PLACE[41] + band[who].astype(np.uint64) * _PLACE[42] \
            + _U(attempt) * _PLACE[43]
        sets.append(which[who])
        sigs.append(mix(sums + mix(tag)))
        which, band = which[failed], band[failed]
    if not sets:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(sets), np.concatenate(sigs)
