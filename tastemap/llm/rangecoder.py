"""Adaptive context-mixing range coder for token ids, vectorised over lanes with numpy.

A block of ids is cut into up to ``LANES`` contiguous lanes that share one model and advance in
step, so every step is a few array operations. The model starts empty in every block. For each
next id it mixes three predictions:

- order 0: adaptive counts of all ids, in cumulative form;
- order 1: the id last seen to follow the previous id, with a confidence;
- order 2: the id last seen to follow the previous two (hashed), with a confidence.

The two predicted ids get extra mass on top of the order-0 counts, in the odds that this pair of
confidences has earned so far in the block. Encoder and decoder update the model alike after each
step, with integer arithmetic only. A carry-less 64-bit range coder per lane turns the intervals
into 16-bit words.
"""

from __future__ import annotations

import numpy as np

LANES = 4096
LANE_BITS = LANES.bit_length() - 1
STEPS = 256
BLOCK = LANES * STEPS
SLOTS = 1 << 18  # order-2 table
INC = 16
MAX_TOTAL = 1 << 24
MAX_ODDS = 60
BITS = 3
LEVELS = 1 << BITS  # confidences 0..7
TOP, BOT = np.uint64(1 << 48), np.uint64(1 << 32)
U = np.uint64

# the steps of an entry's confidence: down by half, rounded up, after a miss, then up by one after a hit
CONF = np.arange(LEVELS)
MOVE = np.concatenate([(CONF >> 1) - CONF, np.minimum(CONF + 1, LEVELS - 1) - CONF]).astype(np.int32)


class _Model:
    def __init__(self, vocab: int, lanes: int):
        self.vocab = vocab
        self.count = np.ones(vocab, np.int64)
        self.cum = np.arange(vocab + 1, dtype=np.int64)
        # a predicted id and, in the low bits, its confidence
        self.table1, self.table2 = np.zeros(vocab, np.int32), np.zeros(SLOTS, np.int32)
        # per pair of confidences: neither prediction right, order 1 alone, order 2
        self.seen = np.tile(np.array([6, 1, 1], np.int64), LEVELS * LEVELS)
        self.prev = np.zeros(lanes, np.int64)
        self.slot = np.zeros(lanes, np.int64)
        self.step = 0
        self.new: list[np.ndarray] = []

    def predict(self):
        """(p1, m1, p2, m2, total): predicted ids, their extra mass, and the whole mass, per lane."""
        self.e1, self.e2 = self.table1.take(self.prev), self.table2.take(self.slot)
        self.conf1, self.conf2 = self.e1 & (LEVELS - 1), self.e2 & (LEVELS - 1)
        self.ctx = (self.conf2 << BITS | self.conf1).astype(np.int64)
        t = int(self.cum[-1])
        rest, hit1, hit2 = self.seen[0::3], self.seen[1::3], self.seen[2::3]
        odds1, odds2 = np.minimum(t * hit1 // rest, t * MAX_ODDS), np.minimum(t * hit2 // rest, t * MAX_ODDS)
        m1, m2, total = (x.take(self.ctx) for x in (odds1, odds2, odds1 + odds2 + t))
        return (self.e1 >> BITS).astype(np.int64), m1, (self.e2 >> BITS).astype(np.int64), m2, total

    def interval(self, s: np.ndarray, p1, m1, p2, m2):
        """(start, mass, p1 is s, p2 is s) of the ids ``s``."""
        is1, is2 = p1 == s, p2 == s
        start, mass = self.cum.take(s), self.cum.take(s + 1)
        mass -= start
        mass += m1 * is1
        mass += m2 * is2
        start += m1 * (s > p1)
        start += m2 * (s > p2)
        return start, mass, is1, is2

    def update(self, s: np.ndarray, is1: np.ndarray, is2: np.ndarray) -> None:
        is1, is2 = is1.view(np.int8), is2.view(np.int8)
        which = self.ctx * 3
        which += np.maximum(is1, is2 << 1)
        self.seen += np.bincount(which, minlength=len(self.seen))
        # a missed prediction loses confidence, and its place when it has none
        entry = s.astype(np.int32) << BITS
        for table, at, hit, e, c in ((self.table1, self.prev, is1, self.e1, self.conf1), (self.table2, self.slot, is2, self.e2, self.conf2)):
            c = c + (hit.astype(np.int32) << BITS)
            e += MOVE.take(c) + (entry - e) * (c == 0)  # no branch on what can't be foretold
            table[at] = e
        self.slot = (self.prev * 40503 + s * 2654435 >> 3) & (SLOTS - 1)
        self.prev = s
        self.new.append(s)
        self.step += 1
        if self.step < 16 or self.step % 6 == 0:
            self.count += np.bincount(np.concatenate(self.new), minlength=self.vocab) * INC
            self.new = []
            np.cumsum(self.count, out=self.cum[1:])
            if self.cum[-1] > MAX_TOTAL:
                self.count = (self.count + 1) >> 1
                np.cumsum(self.count, out=self.cum[1:])


def _move(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lanes whose next word is settled, their low ends before). Intervals are cut where low and high end
    differ although they are short; the lanes are moved on by that word."""
    same = (low ^ (low + size)) < TOP
    short = size < BOT
    if short.any():
        cut = np.flatnonzero(short & ~same)
        size[cut] = (U(0) - low.take(cut)) & (BOT - U(1))
        same |= short
    at = np.flatnonzero(same)
    was = low.take(at)
    by = same.astype(np.uint64) << U(4)
    low <<= by
    size <<= by
    return at, was


def _again(low: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_move` of the lanes ``at``."""
    lo, sz = low.take(at), size.take(at)
    k, was = _move(lo, sz)
    low[at], size[at] = lo, sz
    return at.take(k), was


def encode(ids: np.ndarray, vocab: int) -> bytes:
    """One block of at most ``BLOCK`` ids."""
    n = len(ids)
    if not n:
        return b""
    steps = min(STEPS, n)
    lanes = -(-n // steps)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(vocab, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    # first words of all lanes, second words, ...: lanes fill alike, so one step writes few places
    out = np.zeros((steps * 4 + 8) * lanes, np.uint16)
    to = np.arange(lanes)
    for ids_now in grid:
        s = ids_now.astype(np.int64)
        p1, m1, p2, m2, total = model.predict()
        start, mass, is1, is2 = model.interval(s, p1, m1, p2, m2)
        size //= total.view(np.uint64)
        low += size * start.view(np.uint64)
        size *= mass.view(np.uint64)
        at, was = _move(low, size)
        while len(at):
            w = to.take(at)
            out[w] = was >> U(48)
            to[at] = w + lanes
            at, was = _again(low, size, at)
        model.update(s, is1, is2)
    for shift in (48, 32, 16, 0):
        out[to] = low >> U(shift)
        to += lanes
    fill = to // lanes
    rows = int(fill.max())
    body = np.ascontiguousarray(out[: rows * lanes].reshape(rows, lanes).T)[np.arange(rows) < fill[:, None]]
    return np.concatenate([fill.astype("<u2"), body.astype("<u2")]).tobytes()


def decode(data: bytes, n: int, vocab: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    steps = min(STEPS, n)
    lanes = -(-n // steps)
    words = np.frombuffer(data, "<u2")
    fill = words[:lanes].astype(np.int64)
    words = np.concatenate([words[lanes:], np.zeros(4, "<u2")])
    at_word = np.cumsum(fill) - fill
    model = _Model(vocab, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << U(16)) | words[at_word]
        at_word += 1
    grid = np.empty((steps, lanes), np.int32)
    for k in range(steps):
        p1, m1, p2, m2, total = model.predict()
        size //= total.view(np.uint64)
        x = np.minimum(((code - low) // size).view(np.int64), total - 1)
        # the extra mass of the smaller, then of the larger predicted id follows the counts of that id
        a, b = np.minimum(p1, p2), np.maximum(p1, p2)
        ma = m1 + (m2 - m1) * (p1 > p2)
        mb = m1 + m2 - ma
        over = x - model.cum.take(a + 1)
        past = over >= ma
        in_a = (over >= 0) > past
        x -= ma * past
        over = x - model.cum.take(b + 1)
        past = over >= mb
        in_b = ((over >= 0) > past) > in_a
        x -= mb * past
        s = b + (a - b) * in_a
        rest = np.flatnonzero(~(in_a | in_b))
        # places with their lanes in the low bits: searching in order stays in the cache
        place = x.take(rest) << LANE_BITS
        place |= rest
        place.sort()
        s[place & (LANES - 1)] = np.searchsorted(model.cum, place >> LANE_BITS, "right") - 1
        start, mass, is1, is2 = model.interval(s, p1, m1, p2, m2)
        low += size * start.view(np.uint64)
        size *= mass.view(np.uint64)
        at, _ = _move(low, size)
        while len(at):
            w = at_word.take(at)
            code[at] = (code.take(at) << U(16)) | words.take(w)
            at_word[at] = w + 1
            at, _ = _again(low, size, at)
        model.update(s, is1, is2)
        grid[k] = s
    return np.ascontiguousarray(grid.T).reshape(-1)[:n].astype(np.int64)
