"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks; each block starts from an empty model and has its own
checksum, so any block can be read alone.  An id is predicted from the last two
ids (order 2), from the last id (order 1) and by adaptive frequencies of its
high byte (order 0; its low byte takes eight bits, kept as a byte beside the
code).  The first two predictions get probability from how often predictions of
the same two confidences came true in this block; what they leave goes to order
0.  Predictions are learnt with every id, the shares and frequencies after the
ids of ``_REFIT``.  The mixed distribution drives an arithmetic coder, one
interval an id, with a 56-bit low end, 24-bit output words and carries.

All blocks of a call advance together, one id at a time, as the lanes of numpy
arrays; there is no Python work per id.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048           # ids of a block
LANES = 3072           # blocks that advance together, about
SLOTS = 10             # bits of a context table
MAX_ID = 1 << 16
_U, _V = np.uint64, np.uint32
_TOP, _BITS, _SHIFT, _WORD = _U(1 << 32), _U(56), _U(24), _U(32)
_LOWMASK, _FULL, _WORDMASK = _U((1 << 32) - 1), _U((1 << 56) - 1), _U((1 << 24) - 1)
_PART = 12             # bits of a share, and of a high byte's frequency within what is left to order 0
_ONE = 1 << _PART
_TOTAL = _U(2 * _PART)
_LEAST = 16            # share of order 0 at least
#: Numbers of ids after which shares and frequencies are fitted anew to all ids of the block so far.
_REFIT = (16, 32, 64, 128, 256, *range(512, BLOCK, 256))
#: States of the two predictions: 8 * confidence of order 2 + 2 * confidence of order 1 + whether they agree.
#: A prediction is the id that came last; its confidence how often it came in a row, three at most here.
_STATES = 32
_C2, _C1, _SAME = np.arange(_STATES) >> 3, np.arange(_STATES) >> 1 & 3, np.arange(_STATES) & 1
# Whether a prediction is asked (that of order 1 only where it differs), and its hits among ten made up ones.
_ASK2, _ASK1 = (_C2 > 0).astype(np.int64), ((_C1 > 0) & ((_SAME == 0) | (_C2 == 0))).astype(np.int64)
_PRIOR2, _PRIOR1 = 2 * _C2 * _ASK2, _C1 * _ASK1


class _Model:
    """Predictions of all lanes for one step, and their update."""

    def __init__(self, lanes: int):
        size = 1 << SLOTS
        lane = np.arange(lanes, dtype=np.int64)
        self.lanes = lanes
        self.table = np.empty(2 * lanes * size, _V)  # id << 16 | confidence; order 1, then order 2
        self.table.fill(0)
        self.base = np.stack([lane, lane + lanes]) * size
        self.state_base, self.class_base, self.slot_base = lane * _STATES, lane * 256, lane * _ONE
        gap = max(b - a for a, b in zip((0, *_REFIT), (*_REFIT, BLOCK)))
        self.seen = np.empty((gap, lanes), np.int64)  # states of the steps since the last fit
        self.is2, self.is1 = np.empty((2, gap, lanes), bool)
        self.tries, self.hits2, self.hits1 = np.zeros((3, lanes, _STATES), np.int64)
        self.classes = np.zeros((lanes, 256), np.int64)
        self.at, self.e = np.empty((2, lanes), np.int64), np.empty((2, lanes), _V)
        self.pred, self.conf, self.ctx = np.empty_like(self.e), np.empty_like(self.e), np.empty_like(self.e)
        self.prev, self.prev2 = np.zeros(lanes, _V), np.zeros(lanes, _V)
        self.since = 0
        self._fit()

    def _fit(self) -> None:
        n = self.tries + 10
        a2, a1 = (((k + prior) * (_ONE - _LEAST)) // n * ask for k, prior, ask in
                  ((self.hits2, _PRIOR2, _ASK2), (self.hits1, _PRIOR1, _ASK1)))
        self.chance = ((a2 << 16) | a1).astype(_V).reshape(-1)
        # A frequency of one for each high byte, and the rest as they were seen.
        ends = np.cumsum(self.classes, axis=1, dtype=np.float64)
        ends *= (_ONE - 256) / np.maximum(ends[:, -1:], 1)
        ends = ends.astype(_V)
        ends += np.arange(1, 257, dtype=_V)
        ends[:, -1] = _ONE
        self.freq = ends.copy()
        self.freq[:, 1:] -= ends[:, :-1]
        ends -= self.freq
        ends <<= _V(16)
        ends |= self.freq
        self.spans = ends.reshape(-1)

    def slots(self) -> np.ndarray:
        """High byte of each slot of a lane's frequencies."""
        return np.repeat(np.tile(np.arange(256, dtype=np.uint8), self.lanes), self.freq.reshape(-1))

    def refit(self, ids: np.ndarray) -> None:
        """Fit shares and frequencies to what came since the last time too; ``ids`` by step and lane."""
        seen = self.seen[:self.since]
        for counts, which in ((self.tries, seen.reshape(-1)), (self.hits2, seen[self.is2[:self.since]]),
                              (self.hits1, seen[self.is1[:self.since]])):
            counts += np.bincount(which, minlength=counts.size).reshape(counts.shape)
        self.classes += np.bincount(((ids >> _V(8)) + self.class_base).reshape(-1), minlength=self.classes.size) \
            .reshape(self.classes.shape)
        self.since = 0
        self._fit()

    def predict(self):
        """Shares of order 2 and of order 1."""
        x = self.prev * _V(2654435761)
        self.ctx[0] = x
        y = self.prev2 * _V(2246822519)
        y += _V(374761393)
        y ^= x
        np.multiply(y, _V(2654435761), out=self.ctx[1])
        self.ctx >>= _V(32 - SLOTS)
        np.add(self.ctx, self.base, out=self.at)
        self.table.take(self.at, out=self.e, mode="clip")
        np.bitwise_and(self.e, _V(65535), out=self.conf)
        np.right_shift(self.e, _V(16), out=self.pred)
        c = np.minimum(self.conf, _V(3))
        state = c[1] << _V(2)
        state |= c[0]
        state <<= _V(1)
        state |= self.pred[0] == self.pred[1]
        row = self.seen[self.since]
        np.add(state, self.state_base, out=row)
        a = self.chance.take(row, mode="clip")
        return a >> _V(16), a & _V(65535)

    def update(self, ids: np.ndarray, is2: np.ndarray, is1: np.ndarray) -> None:
        self.is2[self.since], self.is1[self.since] = is2, is1
        self.since += 1
        self.conf *= self.pred == ids
        self.conf += _V(1)
        self.conf |= ids << _V(16)
        self.table[self.at] = self.conf
        self.prev2, self.prev = self.prev, ids


def _passes(n_blocks: int) -> list[int]:
    """Blocks of each pass: all about equal, since a pass with few costs as many steps."""
    if not n_blocks:
        return []
    k = max(1, round(n_blocks / LANES))
    return [n_blocks // k + (i < n_blocks % k) for i in range(k)]


def encode(ids: np.ndarray) -> list[bytes]:
    """Blocks of ``ids`` in order; each is a checksum of its 16-bit ids (4 bytes), its number of
    words (2 bytes), its code and its low bytes."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    if ids.size and int(ids.max()) >= MAX_ID:
        raise ValueError(f"ids must be below {MAX_ID}")
    out: list[bytes] = []
    a = 0
    for lanes in _passes(-(-ids.size // BLOCK)):
        out.extend(_encode_lanes(ids[a:a + lanes * BLOCK], lanes))
        a += lanes * BLOCK
    return out


def _put_hits(m, is2, a2, a1, start, size) -> np.ndarray:
    """Intervals of the lanes ``m``, where a prediction came true; whether it was that of order 2."""
    second, b2 = is2[m], a2[m]
    start[m] = np.where(second, _V(0), b2 << _V(_PART))
    size[m] = np.where(second, b2, a1[m]) << _V(_PART)
    return second


def _encode_lanes(ids: np.ndarray, lanes: int) -> list[bytes]:
    steps = min(BLOCK, ids.size)
    # A short last block is coded with zeros after it.
    cols = np.ascontiguousarray(np.pad(ids, (0, lanes * steps - ids.size)).reshape(lanes, steps).T)
    model = _Model(lanes)
    low, rng = np.zeros(lanes, _U), np.full(lanes, (1 << 56) - 1, _U)
    room = len(model.seen)  # a step gives a word at most
    words, pos = np.zeros((lanes, room), _V), np.zeros(lanes, np.int64)
    escaped = np.empty((steps, lanes), bool)
    for t in range(steps):
        if t in _REFIT:
            model.refit(cols[t - model.since:t])
            more = int(pos.max()) + room - words.shape[1]
            if more > 0:
                words = np.pad(words, ((0, 0), (0, more)))
        s = cols[t]
        a2, a1 = model.predict()
        is2 = (model.pred[1] == s) & (a2 > 0)
        is1 = (model.pred[0] == s) & (a1 > 0) & ~is2
        hit = is2 | is1
        np.logical_not(hit, out=escaped[t])
        first = a2 + a1
        rest = _V(_ONE) - first
        span = model.spans.take((s >> _V(8)) + model.class_base, mode="clip")
        start = (first << _V(_PART)) + rest * (span >> _V(16))
        size = rest * (span & _V(65535))
        _put_hits(np.flatnonzero(hit), is2, a2, a1, start, size)
        r = rng >> _TOTAL
        low += r * start
        rng = r * size
        m = np.flatnonzero(rng < _TOP)
        if m.size:
            at = pos[m]
            x = low[m]
            words[m, at] = x >> _WORD
            pos[m] = at + 1
            low[m] = (x & _LOWMASK) << _SHIFT
            rng[m] <<= _SHIFT
        model.update(s, is2, is1)
    return _flush(words, pos, low, ids, cols, escaped)


def _flush(words, pos, low, ids, cols, escaped) -> list[bytes]:
    carried = np.flatnonzero(low >> _BITS)
    words[carried, pos[carried] - 1] += _V(1)
    low = low & _FULL
    while (carry := words[:, 1:] >> _V(_SHIFT)).any():  # from each word to the one before, seldom further
        words &= _V(_WORDMASK)
        words[:, :-1] += carry
    rest = cols.astype(np.uint8).T[escaped.T]
    ends = np.cumsum(escaped.sum(axis=0)).tolist()
    raw = ids.astype("<u2")
    out, a = [], 0
    for k, end in enumerate(ends):
        n = int(pos[k])
        code = words[k, :n].astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()
        check = zlib.crc32(raw[k * BLOCK:(k + 1) * BLOCK])
        out.append(check.to_bytes(4, "little") + n.to_bytes(2, "little") + code
                   + int(low[k]).to_bytes(7, "big") + rest[a:end].tobytes())
        a = end
    return out


def decode(blocks: list[bytes], n: int) -> np.ndarray:
    """The ``n`` ids of consecutive blocks; a block whose checksum differs raises."""
    parts, a = [], 0
    for lanes in _passes(len(blocks)):
        parts.append(_decode_lanes(blocks[a:a + lanes], min(n - a * BLOCK, lanes * BLOCK)))
        a += lanes
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _decode_lanes(blocks: list[bytes], total: int) -> np.ndarray:
    lanes, steps = len(blocks), min(BLOCK, total)
    counts = [int.from_bytes(b[4:6], "little") for b in blocks]
    # A broken block may ask for more words or low bytes than there are; its checksum tells.
    most, wide = max(counts) + 5, max(len(b) for b in blocks)
    words, lows = np.zeros((lanes, most), _V), np.zeros((lanes, wide), np.uint8)
    val = np.zeros(lanes, _U)
    for k, (b, c) in enumerate(zip(blocks, counts)):
        code = np.frombuffer(b, np.uint8, offset=6, count=min(3 * c + 7, len(b) - 6))
        val[k] = int.from_bytes(b[6:13], "big")
        code = code[7:7 + (code.size - 7) // 3 * 3].reshape(-1, 3).astype(_V)
        words[k, :len(code)] = (code[:, 0] << _V(16)) | (code[:, 1] << _V(8)) | code[:, 2]
        rest = np.frombuffer(b, np.uint8)[13 + 3 * c:]
        lows[k, :rest.size] = rest
    lows, low_at = lows.reshape(-1), np.arange(lanes, dtype=np.int64) * wide
    model = _Model(lanes)
    slots = model.slots()
    rng, pos = np.full(lanes, (1 << 56) - 1, _U), np.zeros(lanes, np.int64)
    cols = np.empty((steps, lanes), _V)
    for t in range(steps):
        if t in _REFIT:
            model.refit(cols[t - model.since:t])
            slots = model.slots()
        a2, a1 = model.predict()
        first = a2 + a1
        rest = _V(_ONE) - first
        r = rng >> _TOTAL
        v = (val // r).astype(_V)
        below = first << _V(_PART)
        hit = v < below
        is2 = v < a2 << _V(_PART)
        is1 = hit ^ is2
        v -= below  # (of a hit: some number, not used)
        v //= rest
        cls = slots.take(v + model.slot_base, mode="clip")
        span = model.spans.take(cls + model.class_base, mode="clip")
        start = below + rest * (span >> _V(16))
        size = rest * (span & _V(65535))
        s = cols[t]
        np.left_shift(cls, _V(8), out=s, dtype=_V)
        s |= lows.take(low_at, mode="clip")
        m = np.flatnonzero(hit)
        second = _put_hits(m, is2, a2, a1, start, size)
        s[m] = np.where(second, model.pred[1][m], model.pred[0][m])
        low_at += ~hit
        val -= r * start
        rng = r * size
        m = np.flatnonzero(rng < _TOP)
        if m.size:
            at = pos[m]
            val[m] = (val[m] << _SHIFT) | words[m, np.minimum(at, most - 1)]
            pos[m] = at + 1
            rng[m] <<= _SHIFT
        model.update(s, is2, is1)
    ids = np.ascontiguousarray(cols.T).reshape(-1)[:total]
    del cols, slots, words, lows
    raw = ids.astype("<u2")
    for k, b in enumerate(blocks):
        if zlib.crc32(raw[k * BLOCK:(k + 1) * BLOCK]) != int.from_bytes(b[:4], "little"):
            raise ValueError(f"checksum of block {k} differs")
    return ids
