"""Vectorised views of an Arrow text column inside a task: bytes, words, hashes, windows.

All functions take whole texts; a null text is an empty one. Words are maximal runs of bytes
accepted by a 256-entry table, so multi-byte characters are never split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64

#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Masks that keep the first 0 to 8 of eight bytes.
KEEP = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)

# multipliers of hashes and windows: fixed by the seeds
STEP = U(0x9E3779B97F4A7C15)
WINDOW_MULT = np.random.default_rng(12).integers(1, 2**63, 4096, dtype=np.uint64) * U(2) + U(1)

#: Words longer than this are hashed one by one.
LANES = 32
LONG = 8 * LANES


def fmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


#: Span hashes are polynomials modulo this prime (2^61 - 1): two different spans of n units agree for
#: at most n of its bases, whatever their contents. (Modulo 2^64 there are spans that agree for all.)
PRIME = U((1 << 61) - 1)
BASE = int(np.random.default_rng(13).integers(1 << 40, (1 << 61) - 2))
_powers: dict[int, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> U(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo ``PRIME``, for values below it."""
    low = U(0xFFFFFFFF)
    ah, al, bh, bl = a >> U(32), a & low, b >> U(32), b & low
    mid = ah * bl + al * bh
    return _reduced(((ah * bh) << U(3)) + (mid >> U(29)) + ((mid & U((1 << 29) - 1)) << U(32)) + _reduced(al * bl))


def sums(x: np.ndarray) -> np.ndarray:
    """Prefix sums (n + 1) modulo ``PRIME``."""
    out = np.zeros(len(x) + 1, np.uint64)
    high = np.cumsum(x >> U(31))
    out[1:] = _reduced((high >> U(30)) + ((high & U((1 << 30) - 1)) << U(31)) + _reduced(np.cumsum(x & U((1 << 31) - 1))))
    return out


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo ``PRIME``; kept for the next call."""
    p = _powers.get(base)
    if p is None:
        p = np.array([1], np.uint64)
    while len(p) < n:
        p = np.concatenate([p, times(p, np.full(len(p), pow(base, len(p), int(PRIME)), np.uint64))])
    _powers[base] = p
    return p[:n]


INVERSE = pow(BASE, -1, int(PRIME))


def span_hashes(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of values[a:b] for many spans, from prefix sums."""
    if not len(a):
        return np.zeros(0, np.uint64)
    s = sums(times(_reduced(values), powers(BASE, len(values))))
    h = times(_reduced(s[b] + (PRIME - s[a])), powers(INVERSE, len(values) + 1)[a])
    return fmix(h + (b - a).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the column as one array, and the n+1 offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """The batches in lists of ``least`` bytes or more, but for the last list."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield held
            held, size = [], 0
    if held:
        yield held


def chunks(off: np.ndarray, max_bytes: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` bytes (or one longer row), which bound the task's arrays."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield i, j
        i = j


def split_words(buf: np.ndarray, off: np.ndarray, table: np.ndarray = NOT_SPACE, cuts: tuple[np.ndarray, np.ndarray] | None = None):
    """(starts, ends, first): byte spans of all words, and the index of each row's first word (n+1).
    ``cuts`` = (before, after) also cuts words between a byte of ``before`` and one of ``after``."""
    inside = table[buf]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    open_ = inside.copy()
    open_[1:] &= ~inside[:-1]
    bounds = off[:-1][off[:-1] < len(buf)]
    open_[bounds] = inside[bounds]
    close = inside.copy()
    close[:-1] &= ~inside[1:]
    bounds = off[1:][off[1:] > 0] - 1
    close[bounds] = inside[bounds]
    if cuts is not None:
        between = cuts[0][buf[:-1]] & cuts[1][buf[1:]]
        open_[1:] |= between
        close[:-1] |= between
    starts = np.flatnonzero(open_)
    return starts, np.flatnonzero(close) + 1, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word; ``lower`` takes A-Z as a-z. Eight bytes at a time are mixed in by a
    bijection, so words of up to eight bytes have hashes of their own; long words are hashed with BLAKE2."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    raw = np.zeros(len(buf) + 8, np.uint8)
    raw[: len(buf)] = LOWER[buf] if lower else buf
    eight = np.ndarray(len(buf) + 1, "<u8", raw.data, strides=(1,))
    n = ends - starts
    h = fmix(np.minimum(n, 8).astype(np.uint64) * STEP)  # further bytes tell their number themselves
    at, left, live = starts, n, None
    for lane in range(LANES):
        word = eight[at] & KEEP[np.minimum(left, 8)]
        if live is None:
            h = fmix(h ^ word)
        else:
            h[live] = fmix(h[live] * STEP + word + left.astype(np.uint64) * U(0xD6E8FEB86659FD93))
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        live = more if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(n > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row index of every word, from the index of each row's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of all windows of k consecutive words that lie in one row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s += h[j : j + n] * WINDOW_MULT[j]
    row = rows_of(first)
    at = np.flatnonzero(row[:n] == row[k - 1 : k - 1 + n])
    return at, fmix(s[at])


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a longer one that begins no column's name: for columns added beside the caller's."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name += "_"
    return name


def join_ranges(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Boolean cover of [0, n) by half-open ranges."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0
