"""N-gram Jaccard join by signature trees.

A document's set is its distinct 5-word shingles (lower-cased A-Z); two documents link when
100 * |A & B| >= 75 * |A | B|. The result is each document's set size and component.

1. One pass over the texts gives every document its set size, a digest of its set and a bitmap with
   one bit per hashed shingle (at least four bits a shingle). Equal sets are one node.
2. Two sets that link share a shingle among the first few of either in any fixed order of all
   shingles. The order puts shingles that many documents hold last. A second pass sends those few,
   with digest and size, to the shingle's bucket; a bucket keeps the lists of nodes that meet
   and could link by size. Equal lists from several shingles are one. The list of a hot shingle
   is split by salts, a list for every pair of salts.
3. Every list gets a signature tree: leaves are nodes' bitmaps, inner nodes hold the OR of their
   bitmaps and the range of sizes. The tree is joined with itself from the top: a pair of inner
   nodes is dropped when the common bits, which bound every overlap below, are too few for any sizes
   in range, or when both sides are already one component. Leaves that pass are candidates.
4. Candidates form clusters (``components``). Each member's text travels once to its cluster, where
   a second signature tree, over the shingles that its members share, one bit each, finds the
   links; its inner nodes drop sets whose shared part is too small. Large clusters are split into pairs of blocks.

Every step only skips pairs that cannot link or that are connected already, so no link between
components is lost, and pairs inside a component are not listed.

Shingles are compared by 64-bit hashes; a node is (digest, size).

Defined cases: a null or empty text, or one without words, has no set and is its own component; fewer
than five words are one shingle; rows that repeat a ``doc_id`` are one document when linking, whatever their texts; a null
``doc_id`` has a null component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm import words as W
from tastemap.llm import workers
from tastemap.llm.components import components
from tastemap.session import materialize

SHINGLE = 5
PERCENT = 75
MIN_HOT = 64
MAX_HOT_IDS = 200_000  # bound of the broadcast list of frequent shingles
LIST_ROWS = 4096  # a longer list of a hot shingle is split by salts
BLOCK_SHINGLES = 4_000_000  # a cluster with more is split into pairs of blocks
FAN = 4
U = np.uint64


def needed(total):
    """Least overlap of two linked sets whose sizes sum to ``total``: 100 o >= 75 (total - o)."""
    return -(-PERCENT * total // (100 + PERCENT))


# ---------------------------------------------------------------- sets
def shingle_sets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, hashes): sorted distinct shingle hashes of every row."""
    starts, ends, first = W.split_words(buf, off)
    h = W.word_hashes(buf, starts, ends, lower=True)
    at, s = W.windows(h, first, SHINGLE)
    row = W.rows_of(first)[at]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        one = np.array([W.fmix(np.array([np.sum(h[first[i] : first[i + 1]] * W.WINDOW_MULT[64 : 64 + count[i]]) + U(int(count[i]))]))[0] for i in short], np.uint64)
        row, s = np.concatenate([row, short]), np.concatenate([s, one])
    order = np.lexsort((s, row))
    row, s = row[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (row[1:] != row[:-1]) | (s[1:] != s[:-1])
    row, s = row[new], s[new]
    return np.searchsorted(row, np.arange(len(off))), s


def width(n: int) -> int:
    """Bits of the bitmap of a set of n: a power of two, at least 4 n and 64."""
    return max(64, 1 << (4 * int(n) - 1).bit_length())


def bitmap(s: np.ndarray) -> bytes:
    bits = np.zeros(width(len(s)), np.uint8)
    bits[(s >> U(20)).astype(np.int64) & (len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _digests(first: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(s[a:b].tobytes()) if b > a else 0 for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], np.uint64).view(np.int64)


def _each(batch: pa.RecordBatch):
    """(row range, first, sets) of a batch, chunk by chunk."""
    buf, off = W.text_bytes(batch.column("text"))
    for i, j in W.chunks(off):
        yield i, j, *shingle_sets(buf[off[i] : off[j]], off[i : j + 1] - off[i])


def profile(docs: DataFrame) -> DataFrame:
    """One pass: rows of documents (doc_id, n, digest, bits of the first with this digest in the
    task) and, with a null ``n``, shingles that three sets or more of a task hold (shingle, digest
    column holding the hash, ``doc_id`` the count)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0

        def frequent() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            h, c = h[c > 2], c[c > 2]
            return _rows(c.astype(np.int64), np.full(len(h), -1), h.view(np.int64), [None] * len(h))

        for batch in batches:
            doc = batch.column("doc_id")
            for i, j, first, s in _each(batch):
                dig = _digests(first, s)
                n = np.diff(first)
                bits = []
                for k, d in enumerate(dig.tolist()):
                    new = n[k] > 0 and d not in seen
                    seen.add(d)
                    bits.append(bitmap(s[first[k] : first[k + 1]]) if new else None)
                    if new:
                        held.append(s[first[k] : first[k + 1]])
                        size += int(n[k])
                yield _rows(doc.slice(i, j - i), n, dig, bits)
                if size > 2_000_000:
                    yield frequent()
                    held, size = [], 0
        yield frequent()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(workers.tidy(task), "doc_id long, n long, digest long, bits binary")


def _rows(doc, n, digest, bits) -> pa.RecordBatch:
    return pa.record_batch({"doc_id": pa.array(doc, pa.int64()), "n": pa.array(n, pa.int64()), "digest": pa.array(digest, pa.int64()), "bits": pa.array(bits, pa.binary())})


def hot_shingles(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the most frequent shingles: at most ``MAX_HOT_IDS``, as each has at
    least total / MAX_HOT_IDS of the counts. Any choice gives the same links; a good one is fast."""
    per = found.filter("n < 0").groupBy("digest").agg(F.sum("doc_id").alias("c"))
    total = per.agg(F.sum("c")).first()[0] or 0
    rows = per.filter(F.col("c") >= max(MIN_HOT, -(-total // MAX_HOT_IDS))).toArrow()
    h, c = rows["digest"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


# ---------------------------------------------------------------- lists of nodes that meet
def entries(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int, list_rows: int = LIST_ROWS) -> DataFrame:
    """(b, keys, digests, sizes): packed prefix entries; the low bit of a size marks the part of the
    prefix in which the smaller of two linked sets must have its first common shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_h, hot_c = shared.value
        seen: set[int] = set()
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            k, d, z = (np.concatenate([x[i] for x in held]) for i in range(3))
            order = np.argsort(k)
            k, d, z = k[order], d[order], z[order]
            cuts = np.searchsorted(k, (np.arange(1, buckets, dtype=np.uint64) * U((1 << 64) // buckets)))
            cuts = np.concatenate([[0], cuts, [len(k)]])
            use = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
            # in a bucket, three bytes of the key tell shingles apart well enough: a false meeting is dropped later
            part = lambda x: pa.array([np.ascontiguousarray(x[cuts[b] : cuts[b + 1]]).tobytes() for b in use], pa.binary())
            return pa.record_batch({"b": pa.array(use, pa.int32()), "keys": part(_three(k)), "digests": part(d), "sizes": part(_narrow(z))})

        for batch in batches:
            for _, _, first, s in _each(batch):
                n = np.diff(first)
                dig = _digests(first, s)
                new = np.zeros(len(n), bool)
                for k, d in enumerate(dig.tolist()):
                    new[k] = n[k] > 0 and d not in seen
                    seen.add(d)
                row = np.repeat(np.arange(len(n)), n)
                order_key = s >> U(1)
                at = np.minimum(np.searchsorted(hot_h, s), max(0, len(hot_h) - 1))
                is_hot = hot_h[at] == s if len(hot_h) else np.zeros(len(s), bool)
                order_key = order_key | (is_hot.astype(np.uint64) << U(63))
                order = np.lexsort((order_key, row))
                pos = np.arange(len(s)) - first[row]
                # |A| - (least overlap with a set of 3/4 its size) + 1 shingles; the smaller needs fewer
                prefix = n - needed(n + -(-PERCENT * n // 100)) + 1
                small = n - needed(2 * n) + 1
                use = (pos < prefix[row]) & new[row]
                order, row_, pos_ = order[use], row[use], pos[use]
                key, digest, flag = W.fmix(s[order]), dig[row_], (n[row_] << 1 | (pos_ < small[row_])).astype(np.int32)
                splits = np.where(is_hot[order], -(-hot_c[at[order]] // list_rows), 1) if len(hot_h) else np.ones(len(order), np.int64)
                one = splits == 1
                held.append((key[one], digest[one], flag[one]))
                for m in np.unique(splits[~one]).tolist():
                    of = splits == m
                    salt = W.fmix(digest[of].view(np.uint64)) % U(m)
                    for t in range(m):
                        lo, hi = np.minimum(salt, U(t)), np.maximum(salt, U(t))
                        held.append((W.fmix(key[of] + lo * W.STEP + hi * U(0xD6E8FEB86659FD93)), digest[of], flag[of]))
                size += int(use.sum())
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(workers.tidy(task), "b int, keys binary, digests binary, sizes binary")


def _three(key: np.ndarray) -> np.ndarray:
    """The low three bytes of each key. A bucket holds as many keys on any input, so its keys rarely agree by chance."""
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3])


def _from_three(cells: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(cells), np.uint8).reshape(-1, 3)
    out = np.zeros((len(raw), 4), np.uint8)
    out[:, :3] = raw
    return out.view("<u4").reshape(-1)


def _narrow(x: np.ndarray) -> np.ndarray:
    """As two bytes each where all fit, else as four."""
    return x.astype(np.uint16 if x.max(initial=0) < 1 << 16 else np.uint32)


def _numbers(cells: pa.ChunkedArray, counts: list[int]) -> list[np.ndarray]:
    """The values of cells of two or four bytes each, of known counts."""
    raw = [x.as_py() for x in cells]
    return [np.frombuffer(r, np.uint16 if len(r) == 2 * n else np.uint32) for r, n in zip(raw, counts, strict=True)]


def meetings(rows: pa.Table) -> pa.Table:
    """The lists of a bucket: nodes that share a key and could link by size, each list once."""
    cat = lambda name, kind: np.frombuffer(b"".join(x.as_py() for x in rows.column(name)), kind)
    keys = [x.as_py() for x in rows.column("keys")]
    key, digest = _from_three(keys), cat("digests", np.int64)
    size = np.concatenate(_numbers(rows.column("sizes"), [len(x) // 3 for x in keys])).astype(np.int64)
    order = np.lexsort((digest, size >> 1, key))
    key, digest, size = key[order], digest[order], size[order]
    n, small = (size >> 1).astype(np.int64), (size & 1).astype(bool)
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (digest[1:] == digest[:-1]) & (n[1:] == n[:-1])
    key, digest, n, small = key[~same], digest[~same], n[~same], small[~same]
    # a list ends where the key or the size leaps
    cut = np.ones(len(key), bool)
    cut[1:] = (key[1:] != key[:-1]) | (100 * n[:-1] < PERCENT * n[1:])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(key))
    out: dict[int, bytes] = {}
    several = end - begin > 1
    for a, b in zip(begin[several].tolist(), end[several].tolist(), strict=True):
        a += int(np.argmax(small[a:b])) if small[a:b].any() else b - a
        if b - a > 1:
            raw = digest[a:b].tobytes() + n[a:b].tobytes()
            out[xxhash.xxh3_64_intdigest(raw)] = raw
    return pa.table({"list": pa.array(np.array(list(out), np.uint64).view(np.int64)), "members": pa.array(list(out.values()), pa.binary())})


def members(lists: DataFrame, buckets: int) -> DataFrame:
    """(b, list, digest, n), one row per member. Lists with the same least member, as near copies have many,
    are in one bucket, so that a node's bitmap goes there once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                raw = [x.as_py() for x in part.column("members")]
                k = [len(x) // 16 for x in raw]
                digest = np.frombuffer(b"".join(x[: 8 * m] for x, m in zip(raw, k, strict=True)), np.int64)
                n = np.frombuffer(b"".join(x[8 * m :] for x, m in zip(raw, k, strict=True)), np.int64)
                least = np.minimum.reduceat(digest, np.cumsum(k) - k)
                b = (W.fmix(least.view(np.uint64)) % U(buckets)).astype(np.int32)
                of = part.column("list").to_numpy(zero_copy_only=False)
                yield pa.record_batch({"b": pa.array(np.repeat(b, k)), "list": pa.array(np.repeat(of, k)), "digest": pa.array(digest), "n": pa.array(n)})

    return lists.mapInArrow(workers.tidy(task), "b int, list long, digest long, n long")


# ---------------------------------------------------------------- signature tree
class Groups:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class Node:
    __slots__ = ("bits", "low", "high", "hidden", "kids", "leaf", "one")

    def __init__(self, bits: int, low: int, high: int, hidden: int, kids: list[Node], leaf: int):
        self.bits, self.low, self.high, self.hidden, self.kids, self.leaf, self.one = bits, low, high, hidden, kids, leaf, not kids


def fold(bits: int, wide: int, narrow: int) -> int:
    """The bitmap of the same set at a smaller power-of-two width."""
    while wide > narrow:
        wide >>= 1
        bits = (bits >> wide) | (bits & ((1 << wide) - 1))
    return bits


def tree(bits: list[int], sizes: list[int], drawn: list[int] | None = None) -> Node:
    """Bulk-loaded over leaves in the given order (by size, so that ranges are narrow). ``drawn``: how
    many shingles of each set are in its bitmap (all). ``hidden`` bounds those that collide on a bit."""
    level = [Node(b, n, n, d - b.bit_count(), [], i) for i, (b, n, d) in enumerate(zip(bits, sizes, drawn or sizes, strict=True))]
    while len(level) > 1:
        up = []
        for i in range(0, len(level), FAN):
            kids = level[i : i + FAN]
            if len(kids) == 1:
                up.append(kids[0])
                continue
            all_bits = 0
            for k in kids:
                all_bits |= k.bits
            up.append(Node(all_bits, min(k.low for k in kids), max(k.high for k in kids), max(k.hidden for k in kids), kids, kids[0].leaf))
        level = up
    return level[0]


def may_link(a: Node, b: Node) -> bool:
    """Whether any set below ``a`` can link with any below ``b``."""
    if 100 * a.high < PERCENT * b.low or 100 * b.high < PERCENT * a.low:
        return False
    most = min((a.bits & b.bits).bit_count() + min(a.hidden, b.hidden), a.high, b.high)
    return most >= needed(a.low + b.low)


def self_join(root: Node, groups: Groups, link: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Dual traversal of the tree with itself: the links that join two groups."""
    out: list[tuple[int, int]] = []

    def within(a: Node) -> None:
        if not a.kids:
            return
        for k in a.kids:
            within(k)
        for i, x in enumerate(a.kids):
            for y in a.kids[i + 1 :]:
                across(x, y)
        r = groups.root(a.leaf)
        a.one = all(k.one and groups.root(k.leaf) == r for k in a.kids)

    def across(first: Node, second: Node) -> None:
        stack = [(first, second)]
        while stack:
            a, b = stack.pop()
            if a.one and b.one and groups.root(a.leaf) == groups.root(b.leaf):
                continue
            if not may_link(a, b):
                continue
            if not a.kids and not b.kids:
                if link(a.leaf, b.leaf):
                    groups.join(a.leaf, b.leaf)
                    out.append((a.leaf, b.leaf))
            elif not b.kids or (a.kids and len(a.kids) * (a.high - a.low + 1) >= len(b.kids) * (b.high - b.low + 1)):
                stack.extend((k, b) for k in a.kids)
            else:
                stack.extend((a, k) for k in b.kids)

    within(root)
    return out


def _ordered_tree(nodes: list[tuple[int, int, bytes]]) -> Node:
    """Tree over (id, n, bitmap) rows, folded to the narrowest width."""
    narrow = min(len(b) * 8 for _, _, b in nodes)
    return tree([fold(int.from_bytes(b, "little"), len(b) * 8, narrow) for _, _, b in nodes], [n for _, n, _ in nodes])


def candidates(listed: pa.Table, nodes: pa.Table) -> pa.Table:
    """Candidate edges of all lists of a bucket, reduced to one star per component of the bucket. ``nodes`` has
    the id and bitmap of every member that has an id."""
    workers.free()
    at = {key: i for i, key in enumerate(zip(nodes.column("digest").to_pylist(), nodes.column("n").to_pylist(), strict=True))}
    of = np.array([at.get(key, -1) for key in zip(listed.column("digest").to_pylist(), listed.column("n").to_pylist(), strict=True)], np.int64)
    lists, of = listed.column("list").to_numpy()[of >= 0], of[of >= 0]
    ids, sizes, maps = nodes.column("id").to_numpy()[of], nodes.column("n").to_numpy()[of], nodes.column("bits").to_pylist()
    order = np.lexsort((ids, sizes, lists))
    lists, of = lists[order], of[order].tolist()
    ids, inv = np.unique(ids[order], return_inverse=True)
    n, bits = sizes[order].tolist(), [maps[i] for i in of]
    begin = np.flatnonzero(np.append(True, lists[1:] != lists[:-1])).tolist()
    inv = inv.tolist()
    all_ = Groups(len(ids))
    for a, b in zip(begin, [*begin[1:], len(lists)], strict=True):
        if b - a == 2:
            if all_.root(inv[a]) != all_.root(inv[a + 1]) and may_link(*_ordered_tree([(0, n[i], bits[i]) for i in (a, a + 1)]).kids):
                all_.join(inv[a], inv[a + 1])
        elif b - a > 2:
            # only what this list shows counts for its own tree, as ``one`` needs whole subtrees
            for x, y in self_join(_ordered_tree([(0, n[i], bits[i]) for i in range(a, b)]), Groups(b - a), lambda x, y: True):
                all_.join(inv[a + x], inv[a + y])
    return _star(ids, all_)


def _star(ids: np.ndarray, groups: Groups) -> pa.Table:
    root = np.array([groups.root(i) for i in range(len(ids))], np.int64)
    far = np.flatnonzero(root != np.arange(len(ids)))
    return pa.table({"u": pa.array(ids[far], pa.int64()), "v": pa.array(ids[root[far]], pa.int64())})


def shared_bitmaps(sets: list[np.ndarray], most_bits: int = 1 << 16) -> tuple[list[int], list[int], bool]:
    """(bitmap, number of shared shingles, exact) over the shingles that two sets or more hold: one bit
    for each, so common bits count common shingles exactly, up to ``most_bits`` of them; beyond, bits
    are shared and common bits bound the overlap from above."""
    flat = np.concatenate(sets)
    _, inv, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keep = count[inv] > 1
    at, of = number[inv[keep]], of[keep]
    exact = int(number[-1]) < most_bits if len(number) else True
    width_ = min(most_bits, int(number[-1]) + 1 if len(number) else 1)
    cut = np.searchsorted(of, np.arange(len(sets) + 1))
    out = []
    for i in range(len(sets)):
        row = np.zeros(width_, np.uint8)
        row[at[cut[i] : cut[i + 1]] % width_] = 1
        out.append(int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little"))
    return out, np.diff(cut).tolist(), exact


def verified(rows: pa.Table) -> pa.Table:
    """Exact links inside the clusters (or pairs of blocks) of a bucket, as stars."""
    workers.free()
    ids, part, sets = rows.column("id").to_numpy(), rows.column("part").to_numpy(), []
    buf, off = W.text_bytes(rows.column("text"))
    for i, j in W.chunks(off):
        first, h = shingle_sets(buf[off[i] : off[j]], off[i : j + 1] - off[i])
        sets.extend(h[x:y] for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
    n = np.array([len(x) for x in sets], np.int64)
    order = np.lexsort((ids, n, part))
    ids, part, n, sets = ids[order], part[order], n[order].tolist(), [sets[i] for i in order.tolist()]
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist()
    out = []
    for a, b in zip(begin, [*begin[1:], len(ids)], strict=True):
        if b - a < 2:
            continue
        here, sizes, groups = sets[a:b], n[a:b], Groups(b - a)
        bits, shared, exact = shared_bitmaps(here)
        # a set whose shingles are too rarely shared links with none here
        able = [i for i in range(b - a) if shared[i] >= needed(sizes[i] + -(-PERCENT * sizes[i] // 100))]
        if len(able) < 2:
            continue

        def link(i: int, j: int, here=here, able=able, exact=exact) -> bool:
            x, y = here[able[i]], here[able[j]]
            return exact or len(np.intersect1d(x, y, assume_unique=True)) >= needed(len(x) + len(y))

        inner = Groups(len(able))
        for x, y in self_join(tree([bits[i] for i in able], [sizes[i] for i in able], [shared[i] for i in able]), inner, link):
            groups.join(able[x], able[y])
        out.append(_star(ids[a:b], groups))
    return pa.concat_tables(out) if out else _star(np.zeros(0, np.int64), Groups(0))


# ---------------------------------------------------------------- the join
FILTER_BITS = 1 << 23


def _probes(col: str) -> list:
    return [F.pmod(F.xxhash64(F.col(col), F.lit(i)), F.lit(FILTER_BITS)) for i in range(3)]


def may_hold(ids: DataFrame, column: str) -> np.ndarray:
    """Bloom filter of a column of ids: ``FILTER_BITS`` bits, whatever the number of ids. It is built by
    an aggregation over words of bits, so the driver gets at most that many bits and no ids."""
    bits = ids.select(F.explode(F.array(*_probes(column))).alias("p"))
    words = bits.groupBy(F.floor(F.col("p") / 32).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("m")).toArrow()
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[words["w"].to_numpy()] = words["m"].to_numpy().astype(np.uint32)
    return out


def keep_maybe(docs: DataFrame, held: np.ndarray, column: str) -> DataFrame:
    """The rows whose id may be in the filter. It spares the shuffle of texts that no cluster needs;
    the join that follows decides, so a full filter costs only that saving."""
    shared = docs.sparkSession.sparkContext.broadcast(held)
    probes = [f"_p{i}" for i in range(3)]
    names = docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for p in probes:
                at = batch.column(p).to_numpy(zero_copy_only=False)
                ok &= (words[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names], names=names).filter(pa.array(ok))

    schema = docs.schema
    return docs.select("*", *[c.alias(p) for c, p in zip(_probes(column), probes, strict=True)]).mapInArrow(workers.tidy(task), schema)


def thinned(cluster: DataFrame, texts: DataFrame, nodes: DataFrame, buckets: int, block_shingles: int) -> DataFrame:
    """The members of clusters that share enough of their shingles with the rest of their cluster to
    link with anyone, with the number of blocks that these need. The shingles of a cluster are counted in
    buckets, so this pass is linear in the cluster, unlike the pairs of blocks that it spares."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, of = batch.column("id").to_numpy(), batch.column("cluster").to_numpy()
            for i, j, first, s in _each(batch):
                n = np.diff(first)
                key = W.fmix(s + np.repeat(W.fmix(of[i:j].astype(np.uint64)), n))
                owner = np.repeat(_narrow(np.arange(j - i)), n)  # texts of a chunk by number, ids once a row
                order = np.argsort(key)
                key, owner = key[order], owner[order]
                cuts = np.searchsorted(key, (np.arange(1, buckets, dtype=np.uint64) * U((1 << 64) // buckets)))
                cuts = np.concatenate([[0], cuts, [len(key)]])
                use = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                part = lambda x, cuts=cuts, use=use: pa.array([np.ascontiguousarray(x[cuts[b] : cuts[b + 1]]).tobytes() for b in use], pa.binary())
                yield pa.record_batch({"b": pa.array(use, pa.int32()), "keys": part(_three(key)), "owners": part(owner), "ids": pa.array([ids[i:j].astype(np.int64).tobytes()] * len(use), pa.binary())})

    def counts(rows: pa.Table) -> pa.Table:
        """The shared shingles of a bucket by text, packed in one row per group of texts."""
        workers.free()
        keys = [x.as_py() for x in rows.column("keys")]
        key = _from_three(keys)  # shingles that meet by chance only leave a member in
        numbers = _numbers(rows.column("owners"), [len(x) // 3 for x in keys])
        owner = np.concatenate([np.frombuffer(i.as_py(), np.int64)[o] for o, i in zip(numbers, rows.column("ids"), strict=True)])
        _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
        ids, c = np.unique(owner[n[inv] > 1], return_counts=True)
        g = (W.fmix(ids.view(np.uint64)) % U(groups)).astype(np.int64)
        order = np.argsort(g, kind="stable")
        ids, c, g = ids[order], c[order], g[order]
        cuts = np.searchsorted(g, np.arange(groups + 1))
        use = [x for x in range(groups) if cuts[x] < cuts[x + 1]]
        part = lambda x, kind: pa.array([x[cuts[k] : cuts[k + 1]].astype(kind).tobytes() for k in use], pa.binary())
        return pa.table({"g": pa.array(use, pa.int32()), "ids": part(ids, np.int64), "counts": part(c, np.uint32)})

    def added(rows: pa.Table) -> pa.Table:
        ids, c = (np.frombuffer(b"".join(x.as_py() for x in rows.column(n)), k) for n, k in (("ids", np.int64), ("counts", np.uint32)))
        ids, inv = np.unique(ids, return_inverse=True)
        return pa.table({"id": pa.array(ids), "c": pa.array(np.bincount(inv, c, len(ids)).astype(np.int64))})

    rows = keep_maybe(texts, may_hold(cluster, "id"), "id").join(cluster, "id").select("id", "cluster", "text")
    groups = max(1, buckets // 4)
    shared = rows.mapInArrow(workers.tidy(pieces), "b int, keys binary, owners binary, ids binary").groupBy("b").applyInArrow(lambda t: counts(t), "g int, ids binary, counts binary")
    shared = shared.groupBy("g").applyInArrow(lambda t: added(t), "id long, c long")
    least = F.ceil(F.lit(PERCENT) * (F.col("n") + F.ceil(PERCENT * F.col("n") / 100)) / (100 + PERCENT))
    able = cluster.join(nodes.select("id", "n"), "id").join(shared, "id").filter(F.col("c") >= least)
    able = materialize(able.select("id", "cluster", "n"), "able")
    size = able.groupBy("cluster").agg(F.ceil(F.sum("n") / block_shingles).alias("blocks"))
    return able.join(size, "cluster").select("id", "cluster", "blocks")


def join(docs: DataFrame, list_rows: int = LIST_ROWS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * parts
    found = materialize(profile(docs), "profile")
    each = found.filter("n >= 0").select("doc_id", "n", "digest")
    # a row without an id may be the one that has its text's bitmap: only nodes without any id are left out
    nodes = found.filter("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("id"), F.max("bits").alias("bits")).filter("id is not null")

    met = entries(docs, hot_shingles(found), buckets, list_rows).groupBy("b").applyInArrow(lambda t: meetings(t), "list long, members binary")
    lists = met.groupBy("list").agg(F.first("members").alias("members"))
    listed = members(lists, buckets)
    known = members(lists, buckets).groupBy(F.col("b").alias("of"), "digest", "n").agg(F.lit(1).alias("one")).join(nodes, ["digest", "n"]).select("of", "digest", "n", "id", "bits")
    maybe = materialize(listed.groupBy("b").cogroup(known.groupBy("of")).applyInArrow(lambda t, w: candidates(t, w), "u long, v long"), "maybe")

    cluster = materialize(components(maybe), "clusters")
    cluster = cluster.select("id", F.col("component").alias("cluster"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    cluster = materialize(thinned(cluster, texts, nodes, buckets, block_shingles), "blocks")
    texts = keep_maybe(texts, may_hold(cluster, "id"), "id")
    # member of block i goes to the pairs (i, j) of every block j
    dealt = texts.join(cluster, "id").withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    part = F.xxhash64("cluster", F.least("i", "j"), F.greatest("i", "j"))
    dealt = dealt.select("id", "text", part.alias("part")).withColumn("b", F.pmod("part", F.lit(buckets)).cast("int"))
    links = materialize(dealt.groupBy("b").applyInArrow(lambda t: verified(t), "u long, v long"), "links")

    # a doc_id with several texts is one document: its texts are linked
    of_id = each.filter("n > 0 and doc_id is not null").select("doc_id", "digest", "n")
    several = of_id.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("doc_id")
    same = of_id.join(materialize(several, "several"), "doc_id").join(nodes.select("digest", "n", "id"), ["digest", "n"]).select(F.col("doc_id").alias("u"), F.col("id").alias("v"))
    links = links.unionByName(same)

    final = nodes.select("digest", "n", "id").join(components(links), "id", "left").select("digest", "n", F.coalesce("component", "id").alias("component_id"))
    out = each.join(final, ["digest", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return join(docs)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that are the first of their group of near copies."""
    name = W.fresh(docs.columns, "_j_id")
    kept = materialize(join(docs).filter("doc_id = component_id or doc_id is null").select(F.col("doc_id").alias(name)).distinct(), "kept")
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")
