"""Windows that repeat across documents: the distributed frame shared by the two exact dedups.

A document is a sequence of units (words or bytes); a window is ``k`` consecutive units. Every
window has a minimiser: the least hash of its ``q``-unit grams. Equal windows have equal
minimisers, so windows may be compared bucket by bucket, and consecutive windows that share a
minimiser travel as one packed string (a run of n windows is n + k - 1 units, not n * k).

A gram that many documents hold in different surroundings would send all of these to one bucket. Such hot
grams are found first (:func:`hot_grams`, a row-local pass) and take part in a window's minimum only where all
of its grams are hot: their windows go to the buckets of other grams. The order of grams is the same for
all windows, so equal windows still have equal minimisers.

Documents are dealt once into groups of about ``GROUP_BYTES`` by a hash of ``doc_id``; the group is the
unit of work and of pre-aggregation, so a minimiser, however hot, reaches its bucket once per group
and never once per document. The steps:

1. group -> bucket: every minimiser with its least document, and whether several have it;
2. bucket -> group: the minimisers that occur in two documents or more;
3. group -> bucket: the distinct packed strings of those, each with its least document;
4. bucket -> group: for every string, the least document of each of its windows (the operator's own
   exact comparison of windows);
5. group: windows whose least document is smaller than the own one are covered and removed.

Steps 3 and 5 read the same exchange of the texts as step 1. Rows between the steps are packed arrays,
one row for each pair of group and bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm import words as W
from tastemap.session import materialize

GROUP_BYTES = 8 << 20
#: A chunk's arrays (eight bytes and more for each of its units) stay in a core's cache.
CHUNK_BYTES = 1 << 18
NO_ID = -(1 << 63)
U = np.uint64

#: A gram occurs that often in a task, and in all tasks, to be hot. At most ``MAX_HOT`` are: the bound rises with
#: the input, as the buckets' number does.
HOT_IN_TASK = 64
HOT = 4096
MAX_HOT = 1 << 20
#: Only grams below this can well be the least of a window.
LOW_GRAM = U((1 << 63) // 6)
BUCKET_BYTES = 4 << 20


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n, m, span = len(a) - w + 1, a, 1
    if n <= 0:
        return a[:0]
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return m[:n] if span == w else np.minimum(m[:n], m[w - span : w - span + n])


class Words:
    """Units are words ``[^\\x20\\x09-\\x0D]+``; a packed string is the words joined by one space."""

    def __init__(self, k: int = 50, q: int = 6):
        self.k, self.q = k, q

    def parse(self, buf: np.ndarray, off: np.ndarray):
        """(first unit of every row (n+1), gram hashes, what ``pack`` needs)"""
        starts, ends, first = W.split_words(buf, off)
        h = W.word_hashes(buf, starts, ends)
        n = max(0, len(h) - self.q + 1)
        g = np.zeros(n, np.uint64)
        for j in range(self.q):
            g += h[j : j + n] * W.WINDOW_MULT[j]
        return first, W.fmix(g), (buf.tobytes(), starts, ends, h)

    def hashes(self, ctx, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the units [a, b), the same for equal packed strings anywhere."""
        return W.span_hashes(ctx[3], a, b)

    def string_hashes(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """``hashes`` of whole packed strings."""
        out = [np.zeros(0, np.uint64)]
        for i, j in W.chunks(off, CHUNK_BYTES):
            b = buf[off[i] : off[j]]
            starts, ends, first = W.split_words(b, off[i : j + 1] - off[i])
            out.append(W.span_hashes(W.word_hashes(b, starts, ends), first[:-1], first[1:]))
        return np.concatenate(out)

    def pack(self, ctx, a: np.ndarray, b: np.ndarray) -> list[bytes]:
        raw, starts, ends, _ = ctx
        return [b" ".join(raw[x:y].split()) for x, y in zip(starts[a].tolist(), ends[b - 1].tolist(), strict=True)]


class Bytes:
    """Units are bytes."""

    def __init__(self, k: int = 50, q: int = 20):
        if q != 20 or k < q:
            raise ValueError("grams of 20 bytes")
        self.k, self.q = k, q

    def parse(self, buf: np.ndarray, off: np.ndarray):
        n = max(0, len(buf) - self.q + 1)
        raw = np.zeros(len(buf) + 8, np.uint8)
        raw[: len(buf)] = buf
        eight = np.ndarray(len(buf) + 1, "<u8", raw.data, strides=(1,)).copy()  # aligned, so arithmetic is fast
        # a minimiser only deals windows out, so two rounds of mixing do
        g = eight[:n] * W.WINDOW_MULT[0]
        g += eight[8 : 8 + n] * W.WINDOW_MULT[1]
        g += (eight[16 : 16 + n] << U(32)) * W.WINDOW_MULT[2]
        g ^= g >> U(32)
        g *= W.WINDOW_MULT[3]
        g ^= g >> U(32)
        g *= W.WINDOW_MULT[4]
        return off, g, buf

    def hashes(self, ctx, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return W.word_hashes(ctx, a, b)

    def string_hashes(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        out = [np.zeros(0, np.uint64)]
        for i, j in W.chunks(off, CHUNK_BYTES):
            o = off[i : j + 1] - off[i]
            out.append(W.word_hashes(buf[off[i] : off[j]], o[:-1], o[1:]))
        return np.concatenate(out)

    def pack(self, ctx, a: np.ndarray, b: np.ndarray) -> list[bytes]:
        raw = ctx.tobytes()
        return [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def runs(unit, first: np.ndarray, gram: np.ndarray):
    """(row, first unit, number of windows, key) of the maximal runs of windows with one minimiser.
    The key is a mix of the minimiser, as minimisers themselves crowd near zero."""
    m = sliding_min(gram, unit.k - unit.q + 1)
    n = len(m)
    z = np.zeros(0, np.int64)
    if not n:
        return z, z, z, np.zeros(0, np.uint64)
    rows = np.flatnonzero(np.diff(first) >= unit.k)
    d = np.zeros(n + 1, np.int8)
    d[first[rows]] += 1
    np.add.at(d, first[rows + 1] - unit.k + 1, -1)
    ok = np.cumsum(d[:n], dtype=np.int8).view(bool)
    new = ok.copy()
    new[1:] &= ~(ok[:-1] & (m[1:] == m[:-1]))
    # adjoining rows share no window, but their windows may adjoin when k is 1
    new[first[rows]] = True
    at = np.flatnonzero(new)
    row = np.searchsorted(first, at, "right") - 1
    stop = np.minimum(np.append(at[1:], n), first[row + 1] - unit.k + 1)
    return row, at, stop - at, W.fmix(m[at] + W.STEP)


class _Members:
    """Sorted values; a table of the bits from ``shift`` on tells most others."""

    def __init__(self, sorted_: np.ndarray, shift: int = 0, bits: int = 16):
        self.sorted, self.shift, self.mask = sorted_, U(shift), U((1 << bits) - 1)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self._place(sorted_)] = True

    def _place(self, x: np.ndarray) -> np.ndarray:
        return ((x >> self.shift) & self.mask).view(np.int64)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the values of ``x`` that are among them, which these are)"""
        at = np.flatnonzero(self.seen[self._place(x)])
        x = x[at]
        which = np.minimum(np.searchsorted(self.sorted, x), len(self.sorted) - 1)
        hit = np.flatnonzero(self.sorted[which] == x)
        return at[hit], which[hit]


def demoted(gram: np.ndarray, hot: np.ndarray | _Members) -> np.ndarray:
    """The grams' hashes with the hot ones above all others. ``hot`` is sorted."""
    gram = gram >> U(1)
    hot = hot if isinstance(hot, _Members) else _Members(hot, 47)
    if not len(hot.sorted):
        return gram
    at = np.flatnonzero(gram <= hot.sorted[-1])
    gram[at[hot.find(gram[at])[0]]] |= U(1 << 63)
    return gram


def hot_grams(texts: DataFrame, unit) -> np.ndarray:
    """Sorted hashes of the frequent grams among those with a low hash: at most ``MAX_HOT``, as each has its
    share of all."""
    in_task, least = HOT_IN_TASK, HOT

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0

        def frequent() -> pa.RecordBatch:
            m, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            m, n = m[n >= in_task], n[n >= in_task]
            return pa.record_batch({"gram": pa.array(np.append(m.view(np.int64), -1)), "n": pa.array(np.append(n, total).astype(np.int64))})

        for batch in batches:
            buf, off = W.text_bytes(batch.column("text"))
            for i, j in W.chunks(off, CHUNK_BYTES):
                m = demoted(unit.parse(buf[off[i] : off[j]], off[i : j + 1] - off[i])[1], np.zeros(0, np.uint64))
                m = m[m < LOW_GRAM]
                held.append(m)
                size, total = size + len(m), total + len(m)
                if size > 4_000_000:
                    yield frequent()
                    held, size, total = [], 0, 0
        yield frequent()

    per = texts.select("text").mapInArrow(counting, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    per = materialize(per, "hot")
    total = per.filter("gram = -1").agg(F.sum("n")).first()[0] or 0
    found = per.filter((F.col("gram") >= 0) & (F.col("n") >= max(least, -(-total // MAX_HOT)))).toArrow()
    return np.sort(found.column("gram").to_numpy().view(np.uint64)) if found.num_rows else np.zeros(0, np.uint64)


def _bucket_cuts(key: np.ndarray, buckets: int) -> np.ndarray:
    """Positions that cut sorted keys into buckets."""
    edges = (np.arange(1, buckets, dtype=np.uint64) * U((1 << 64) // buckets)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(key, edges), [len(key)]])


def _six(key: np.ndarray) -> np.ndarray:
    """The low six bytes of sorted keys. The bucket is the top of the key, so little is lost; keys that
    meet by chance in step 1 only send a string too many in step 3."""
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view("<u8").reshape(-1)


LOW6 = U((1 << 48) - 1)
#: Bits of the table of a group's keys.
KEY_BITS = 21


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)


def _chunks(docs: pa.Table, unit, hot: np.ndarray):
    """(document ids, row offsets of bytes, first units, ctx, runs) of a group, chunk by chunk."""
    buf, off = W.text_bytes(docs.column("text"))
    doc = docs.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False) if docs.num_rows else np.zeros(0, np.int64)
    frequent = _Members(hot, 47)
    for i, j in W.chunks(off, CHUNK_BYTES):
        b, o = buf[off[i] : off[j]], off[i : j + 1] - off[i]
        first, gram, ctx = unit.parse(b, o)
        yield doc[i:j], b, o, first, ctx, runs(unit, first, demoted(gram, frequent))


def _changes(k: np.ndarray, h: np.ndarray) -> np.ndarray:
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
    return new


def _order(k: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
    """An order that sorts ``k`` and, where these are equal, ``h``. Values that hold the top of the key and the
    position are sorted, which is many times faster than positions; where the top does not tell, all does."""
    bits = U(len(k).bit_length())
    x = (k >> bits << bits) | np.arange(len(k), dtype=np.uint64)
    x.sort()
    order = (x & ((U(1) << bits) - U(1))).view(np.int64)
    top = x >> bits
    new = top[1:] != top[:-1]
    wrong = ~new & (_changes(k[order], (k if h is None else h)[order])[1:])
    if wrong.any():
        run = np.concatenate([[0], np.cumsum(new)])
        mixed = np.zeros(int(run[-1]) + 1, bool)
        mixed[run[1:][wrong]] = True
        at = np.flatnonzero(mixed[run])
        some = order[at]
        order[at] = some[np.lexsort((k[some],) if h is None else (h[some], k[some]))]
    return order


class _Pairs:
    """Finds (key, hash) pairs in a list of them; both have to agree."""

    def __init__(self, k: np.ndarray, h: np.ndarray):
        self.order = _order(k, h)
        k, self.h = k[self.order], h[self.order]
        self.begin = np.flatnonzero(_changes(k, k))
        self.last = np.append(self.begin[1:], len(k)) - 1
        self.keys = _Members(k[self.begin], 0, KEY_BITS)

    def find(self, which: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Position of each pair in the list, -1 where it is not; ``which`` of the keys is known."""
        low, high = self.begin[which], self.last[which]
        open_ = np.flatnonzero(low < high)
        while len(open_):  # halves each key's hashes
            a, b = low[open_], high[open_]
            mid = (a + b) >> 1
            less = self.h[mid] < h[open_]
            low[open_], high[open_] = a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            open_ = open_[a < b]
        return np.where(self.h[low] == h, self.order[low], -1)


def spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each of ``begin`` on, ``n`` of each."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _list(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def remove(docs: DataFrame, unit, least_docs: Callable, finish: Callable, schema: str, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row of ``schema`` per document of ``docs`` (doc_id, text).

    ``least_docs(keys, strings, docs)`` is the operator's comparison: the least documents of the windows of all
    strings, one string after the other, and the number of windows of each. ``finish(buf, off, first, covered)``
    makes the arrays of the result from a chunk and its covered units.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, buckets = max(1, -(-total // group_bytes)), max(4 * parts, -(-total // BUCKET_BYTES))
    hot = spark.sparkContext.broadcast(hot_grams(texts, unit))
    dealt = texts.withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int")).repartition(parts, "g")

    def minimisers(key, docs_):
        keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for doc, _, _, _, _, (row, _, _, k) in _chunks(docs_, unit, hot.value):
            keys.append(k)
            ids.append(doc[row])
        k, d = np.concatenate(keys), np.concatenate(ids)
        order = _order(k)
        k, d = k[order], d[order]
        head = np.flatnonzero(_changes(k, k))
        k, high, d = k[head], np.maximum.reduceat(d, head), np.minimum.reduceat(d, head)
        many = d != high
        cuts = _bucket_cuts(k, buckets)
        use = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        g = key[0].as_py()
        part = lambda x: pa.array([_list(x[cuts[b] : cuts[b + 1]]) for b in use], pa.binary())
        return pa.table({"b": pa.array(use, pa.int32()), "g": pa.array([g] * len(use), pa.int32()), "keys": part(_six(k)), "docs": part(d), "many": part(many)})

    def shared(key, rows):
        k, d, many = _from_six(_column(rows, "keys", np.uint8)), _column(rows, "docs", np.int64), _column(rows, "many", bool)
        source = np.repeat(np.arange(rows.num_rows), [len(x.as_py()) for x in rows.column("many")])
        order = _order(k)
        k_, d_, m_ = k[order], d[order], many[order]
        head = np.flatnonzero(_changes(k_, k_))
        count = np.diff(np.append(head, len(k_)))
        several = (np.minimum.reduceat(d_, head) != np.maximum.reduceat(d_, head)) | np.logical_or.reduceat(m_, head)
        keep = np.repeat(several, count)
        src, kk = source[order][keep], k_[keep]
        by = np.argsort(src, kind="stable")
        src, kk = src[by], kk[by]
        cut = np.searchsorted(src, np.arange(rows.num_rows + 1))
        g = rows.column("g").to_numpy()
        use = [i for i in range(rows.num_rows) if cut[i] < cut[i + 1]]
        return pa.table({"g": pa.array([int(g[i]) for i in use], pa.int32()), "keys": pa.array([_list(_six(kk[cut[i] : cut[i + 1]])) for i in use], pa.binary())})

    def strings(key, docs_, wanted):
        want = np.sort(_from_six(_column(wanted, "keys", np.uint8)))
        keys_wanted = _Members(want, 0, KEY_BITS)
        keys, hashes, lows, highs, packed = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for doc, _, _, _, ctx, (row, at, n, k) in _chunks(docs_, unit, hot.value) if len(want) else ():
            hit = keys_wanted.find(k & LOW6)[0]
            at, end = at[hit], at[hit] + n[hit] + unit.k - 1
            # one row and one text for each string of the chunk, with its least and its greatest document
            k, h, d = k[hit], unit.hashes(ctx, at, end), doc[row[hit]]
            order = _order(k, h)
            head = np.flatnonzero(_changes(k[order], h[order]))
            first = order[head]
            keys.append(k[first])
            hashes.append(h[first])
            lows.append(np.minimum.reduceat(d[order], head))
            highs.append(np.maximum.reduceat(d[order], head))
            packed.extend(unit.pack(ctx, at[first], end[first]))
        k, h, low, high = np.concatenate(keys), np.concatenate(hashes), np.concatenate(lows), np.concatenate(highs)
        order = _order(k, h)
        head = np.flatnonzero(_changes(k[order], h[order]))
        first = order[head]
        k, d, texts = k[first], np.minimum.reduceat(low[order], head), [packed[i] for i in first.tolist()]
        many = d != np.maximum.reduceat(high[order], head)
        lens = np.array([len(x) for x in texts], np.int32)
        cuts = _bucket_cuts(k, buckets)
        use = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        part = lambda x: pa.array([_list(x[cuts[b] : cuts[b + 1]]) for b in use], pa.binary())
        zip_ = zstandard.ZstdCompressor(level=1)
        return pa.table(
            {
                "b": pa.array(use, pa.int32()),
                "g": pa.array([key[0].as_py()] * len(use), pa.int32()),
                "keys": part(k),
                "docs": part(d),
                "many": part(many),
                "lens": part(lens),
                "strings": pa.array([zip_.compress(b"".join(texts[cuts[b] : cuts[b + 1]])) for b in use], pa.binary()),
            }
        )

    def compare(key, rows):
        k, d = _column(rows, "keys", np.uint64), _column(rows, "docs", np.int64)
        many, lens = _column(rows, "many", bool), _column(rows, "lens", np.int32)
        unzip = zstandard.ZstdDecompressor()
        raw = b"".join(unzip.decompress(x.as_py()) for x in rows.column("strings"))
        ends = np.cumsum(lens.astype(np.int64))
        source = np.repeat(np.arange(rows.num_rows), [len(x.as_py()) for x in rows.column("many")])
        h = unit.string_hashes(np.frombuffer(raw, np.uint8), np.concatenate([[0], ends]))
        # equal strings of several groups are one
        order = _order(k, h)
        new = _changes(k[order], h[order])
        head = order[new]
        which = np.empty(len(k), np.int64)
        which[order] = np.cumsum(new) - 1
        least, of_key = np.minimum.reduceat(d[order], np.flatnonzero(new)), k[head]
        alone = np.ones(len(head), bool)
        alone[1:] &= of_key[1:] != of_key[:-1]
        alone[:-1] &= of_key[1:] != of_key[:-1]
        # a key with one string needs no comparison: its windows occur where the string does
        size, values = np.ones(len(head), np.int64), least.copy()
        mixed = np.flatnonzero(~alone)
        if len(mixed):
            texts = [raw[e - n : e] for e, n in zip(ends[head[mixed]].tolist(), lens[head[mixed]].tolist(), strict=True)]
            found, n = least_docs(of_key[mixed], texts, least[mixed])
            begin = np.cumsum(n) - n
            # one value stands for windows that all have it
            one = np.minimum.reduceat(found, begin) == np.maximum.reduceat(found, begin)
            stay = ~np.repeat(one, n)
            stay[begin] = True
            size[mixed] = np.where(one, 1, n)
            begin = np.cumsum(size) - size
            values = np.empty(int(size.sum()), np.int64)
            values[begin[alone]] = least[alone]
            values[spread(begin[mixed], size[mixed])] = found[stay]
        begin = np.cumsum(size) - size
        low = np.minimum.reduceat(values, begin) if len(begin) else values
        # where nothing of the group goes, it needs no word of it
        tell = np.flatnonzero(many | (low[which] < d))
        tell = tell[np.argsort(source[tell], kind="stable")]
        w = which[tell]
        n = size[w]
        flat = values[spread(begin[w], n)]
        cut = np.searchsorted(source[tell], np.arange(rows.num_rows + 1))
        flat_cut = np.concatenate([[0], np.cumsum(n)])[cut]
        g = rows.column("g").to_pylist()
        use = [i for i in range(rows.num_rows) if cut[i] < cut[i + 1]]
        part = lambda x, c=cut: pa.array([_list(x[c[i] : c[i + 1]]) for i in use], pa.binary())
        return pa.table({"g": pa.array([g[i] for i in use], pa.int32()), "keys": part(k[tell]), "hashes": part(h[tell]), "lens": part(n.astype(np.int32)), "least": part(flat, flat_cut)})

    def apply(key, docs_, verdicts):
        known = _Pairs(_column(verdicts, "keys", np.uint64), _column(verdicts, "hashes", np.uint64))
        lens, flat = _column(verdicts, "lens", np.int32).astype(np.int64), _column(verdicts, "least", np.int64)
        begin = np.cumsum(lens) - lens
        tables = []
        for doc, buf, off, first, ctx, (row, at, n, k) in _chunks(docs_, unit, hot.value):
            units = int(first[-1])
            covered = np.zeros(units, bool)
            hit, which = known.keys.find(k)
            if len(hit):
                verdict = known.find(which, unit.hashes(ctx, at[hit], at[hit] + n[hit] + unit.k - 1))
                hit, verdict = hit[verdict >= 0], verdict[verdict >= 0]
                d = doc[row[hit]]
                whole = lens[verdict] == 1
                gone = hit[whole & (flat[begin[verdict]] < d)]
                hit, verdict, d = hit[~whole], verdict[~whole], d[~whole]
                m = lens[verdict]
                one = spread(at[hit], m)[flat[spread(begin[verdict], m)] < np.repeat(d, m)]
                covered = W.join_ranges(np.concatenate([at[gone], one]), np.concatenate([at[gone] + n[gone] + unit.k - 1, one + unit.k]), units)
            tables.append(pa.table({"doc_id": pa.array(doc, mask=doc == NO_ID), **finish(buf, off, first, covered)}))
        return pa.concat_tables(tables)

    keyed = dealt.groupBy("g").applyInArrow(minimisers, "b int, g int, keys binary, docs binary, many binary")
    both = keyed.groupBy("b").applyInArrow(shared, "g int, keys binary")
    packed = dealt.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(strings, "b int, g int, keys binary, docs binary, many binary, lens binary, strings binary")
    judged = packed.groupBy("b").applyInArrow(compare, "g int, keys binary, hashes binary, lens binary, least binary")
    return dealt.groupBy("g").cogroup(judged.groupBy("g")).applyInArrow(apply, schema)


def row_sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return c[first[1:]] - c[first[:-1]]


def split_rows(parts: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield parts[a:b]
