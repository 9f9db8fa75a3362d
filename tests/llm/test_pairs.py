"""Jaccard join and the substring dedups against brute force."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from tastemap.llm import jaccard, repeats, substring, suffixes
from tastemap.llm import words as W
from tastemap.llm.components import components
from tests.llm.conftest import DOCS, clashing, words


def brute_join(rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(r[0], shingles(r[1])) for r in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = root(i), root(j)
            up[max(x, y)] = min(x, y)
    return sorted((i is None, i or 0, len(s), None if i is None else root(i)) for i, s in sets)


def got_join(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize(("list_rows", "block_shingles"), [(4096, 2_000_000), (3, 700)])
def test_join(docs, corpus, list_rows, block_shingles):
    assert got_join(jaccard.join(clashing(docs), list_rows, block_shingles)) == brute_join(corpus)


def test_join_edges(spark, empty_docs):
    assert jaccard.join(empty_docs).collect() == []
    rows = [(None, "a b c d e f", "en", "s", 0), (3, "a b c d e f", "en", "s", 0), (3, "a b c d e f", "en", "s", 0), (9, "A B C D E F", None, None, 0), (7, None, None, None, None)]
    got = got_join(jaccard.join(spark.createDataFrame(rows, DOCS)))
    assert got == [(False, 3, 2, 3), (False, 3, 2, 3), (False, 7, 0, 7), (False, 9, 2, 3), (True, 0, 2, None)]


def test_join_hot_group(spark, monkeypatch):
    """A large group of near copies: frequent shingles go last, their lists are split."""
    monkeypatch.setattr(jaccard, "MIN_HOT", 5)
    rng = random.Random(2)
    base, rows = words(rng, 120), []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = "z%d" % rng.randrange(10**6)
        rows.append((i, " ".join(w), "en", "s", 0))
    rows += [(1000 + i, " ".join(words(rng, 60) + base[:40]), "en", "s", 0) for i in range(60)]
    assert got_join(jaccard.join(spark.createDataFrame(rows, DOCS), 20, 1500)) == brute_join(rows)


def test_bound_never_drops_a_link():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    for _ in range(300):
        a = np.unique(rng.choice(pool, rng.integers(1, 200)))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(1, len(a) + 1)), rng.choice(pool, rng.integers(0, 30))]))
        inter = len(np.intersect1d(a, b))
        if 100 * inter >= 75 * (len(a) + len(b) - inter):
            root = jaccard._ordered_tree([(0, len(x), jaccard.bitmap(x)) for x in (a, b)])
            assert jaccard.may_link(*root.kids)
            assert inter >= jaccard.needed(len(a) + len(b))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_keep_one(docs, corpus):
    firsts = {r[3] for r in brute_join(corpus)}
    kept = jaccard.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert {r.doc_id for r in kept.collect()} == firsts


def brute_removed(rows, k, split):
    first = {}
    low = [(-(2**63) if i is None else i, i, split(t or "")) for i, t in rows]
    for key, _, u in low:
        for a in range(len(u) - k + 1):
            w = tuple(u[a : a + k])
            first[w] = min(first.get(w, key), key)
    for key, i, u in low:
        gone = bytearray(len(u))
        for a in range(len(u) - k + 1):
            if first[tuple(u[a : a + k])] < key:
                gone[a : a + k] = b"\1" * k
        yield i, u, gone


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("group_bytes", [1 << 30, 3000])
def test_substring(docs, corpus, group_bytes):
    got = substring.dedup(clashing(docs), group_bytes=group_bytes)
    want = [(i, len(u), sum(g), hashlib.sha256(b" ".join(w for w, x in zip(u, g, strict=True) if not x)).hexdigest()) for i, u, g in brute_removed([r[:2] for r in corpus], 50, lambda t: t.encode().split())]
    assert sorted_rows(tuple(r)[:4] for r in got.collect()) == sorted_rows(want)
    assert sum(r[2] for r in want) > 100


@pytest.mark.parametrize("group_bytes", [1 << 30, 3000])
def test_suffixes(docs, corpus, group_bytes):
    got = suffixes.dedup(clashing(docs), group_bytes=group_bytes)
    want = []
    for i, u, g in brute_removed([r[:2] for r in corpus], 50, str.encode):
        kept = bytes(b for b, x in zip(u, g, strict=True) if not x)
        want.append((i, len(u), sum(g), len(re.findall(rb"\x01+", bytes(g))), hashlib.sha256(kept).hexdigest()))
    assert sorted_rows(tuple(r)[:5] for r in got.collect()) == sorted_rows(want)


@pytest.mark.parametrize("op", [substring, suffixes])
def test_dedup_edges(spark, empty_docs, op):
    assert op.dedup(empty_docs).collect() == []
    text = " ".join(words(random.Random(1), 80))
    rows = [(5, text, None, None, 0), (5, text, None, None, 0), (None, "", None, None, 0), (8, text + " tail", None, None, 0), (2, None, None, None, 0)]
    got = {(r.doc_id, r.n_removed > 0) for r in op.dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(5, False), (None, False), (8, True), (2, False)}


def test_runs_cover_all_windows():
    unit = repeats.Words()
    rng = random.Random(3)
    texts = [" ".join(words(rng, n)).encode() for n in (0, 49, 50, 51, 300, 7)] + [b"x " * 200]
    off = np.cumsum([0] + [len(t) for t in texts])
    first, gram, _ = unit.parse(np.frombuffer(b"".join(texts), np.uint8), off)
    row, at, n, _ = repeats.runs(unit, first, gram)
    seen = sorted(x for a, k in zip(at, n, strict=True) for x in range(a, a + k))
    assert seen == [x for a, b in itertools.pairwise(first) for x in range(a, b - 49)]
    assert all(first[r] <= a and a + k + 49 <= first[r + 1] for r, a, k in zip(row, at, n, strict=True))


def test_radix_groups_against_sorting():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 400).astype(np.uint8)
    at, start = np.arange(380), np.arange(380) % 2
    member, group = suffixes.radix_groups(data, at, start, 11)
    want = {}
    for i in at:
        want.setdefault((start[i], bytes(data[i : i + 11])), set()).add(i)
    got = {}
    for m, g in zip(member.tolist(), group.tolist(), strict=True):
        got.setdefault(g, set()).add(m)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_join_takes_the_bitmap_of_a_row_without_id(spark):
    w = [f"word{i}" for i in range(200)]
    near = " ".join(w[:100] + ["changed"] + w[101:])
    rows = [(None, " ".join(w), "en", "s", 0), (1, " ".join(w), "en", "s", 0), (2, near, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    got = {r.doc_id: r.component_id for r in jaccard.report(df).collect()}
    assert got == {None: None, 1: 1, 2: 1}


# ---------------------------------------------------------------- hot minimisers
def _phrase_rows(n, rng, unit):
    """A phrase of six words in different surroundings, some of them copied; the hash of a gram of it is low."""
    while True:
        phrase = " ".join(words(rng, 6))
        raw = np.frombuffer(phrase.encode(), np.uint8)
        if 22 < len(raw) < 30 and unit.parse(raw, np.array([0, len(raw)]))[1].min() < 1 << 57:
            break
    texts = [" ".join(words(rng, 70)) + f" {phrase} " + " ".join(words(rng, 70)) for _ in range(n)]
    texts += texts[: n // 8]
    texts.append(f"{phrase} " * 30)  # hot grams only
    texts.append(f"{phrase} " * 25)
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def _brute(rows, k, split):
    first, out = {}, {}
    for i, t, *_ in rows:
        w = split(t)
        for a in range(len(w) - k + 1):
            first[w[a : a + k]] = min(first.get(w[a : a + k], i), i)
    for i, t, *_ in rows:
        w = split(t)
        gone = {j for a in range(len(w) - k + 1) if first[w[a : a + k]] < i for j in range(a, a + k)}
        out[i] = len(gone)
    return out


@pytest.mark.parametrize("op", ["words", "bytes"])
def test_hot_minimiser_is_spread(spark, monkeypatch, op):
    rng = random.Random(12)
    report, unit = (substring.report, repeats.Words()) if op == "words" else (suffixes.report, repeats.Bytes())
    rows = _phrase_rows(160, rng, unit)
    want = _brute(rows, 50, (lambda t: tuple(t.split())) if op == "words" else (lambda t: t.encode()))
    monkeypatch.setattr(repeats, "HOT_IN_TASK", 8)
    monkeypatch.setattr(repeats, "HOT", 60)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    hot = repeats.hot_grams(df.select("doc_id", "text"), unit)
    assert 0 < len(hot) < 60
    assert {r.doc_id: r.n_removed for r in report(df).collect()} == want
    # no minimiser is left that nearly every document has
    buf = np.frombuffer("".join(r[1] for r in rows).encode(), np.uint8)
    off = np.cumsum([0] + [len(r[1].encode()) for r in rows])
    most = []
    for h in (hot, hot[:0]):
        first, gram, _ = unit.parse(buf, off)
        row, _, _, key = repeats.runs(unit, first, repeats.demoted(gram, h))
        pairs = np.unique(np.stack([key, row.astype(np.uint64)]), axis=1)[0]
        most.append(np.unique(pairs, return_counts=True)[1].max())
    assert most[0] < 0.3 * most[1] and most[1] >= 60


def _spans(unit, texts):
    buf, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    first, gram, ctx = unit.parse(buf, off)
    _, at, n, _ = repeats.runs(unit, first, gram)
    return ctx, at, at + n + unit.k - 1


def test_byte_spans_have_the_hash_of_their_strings():
    rng = random.Random(21)
    texts = [" ".join(words(rng, 400)).encode(), b"k" * 900, bytes(range(256)) * 4, b"", b"a" * 49]
    unit = repeats.Bytes()
    ctx, a, b = _spans(unit, [*texts, *texts])
    h, packed = unit.hashes(ctx, a, b), unit.pack(ctx, a, b)
    assert len(set(zip(h.tolist(), packed, strict=True))) == len(set(h.tolist())) == len(set(packed)) < len(packed)
    assert (unit.string_hashes(np.frombuffer(b"".join(packed), np.uint8), np.cumsum([0] + [len(x) for x in packed])) == h).all()
    assert not len(_spans(unit, [b"", b"x" * 49])[1])


def test_byte_spans_cost_less_than_sums_over_all_bytes():
    unit = repeats.Bytes()
    ctx, a, b = _spans(unit, [np.random.default_rng(3).integers(97, 123, 1_000_000).astype(np.uint8).tobytes()])

    def cpu(f):
        took = []
        for _ in range(5):
            t = time.process_time()
            f()
            took.append(time.process_time() - t)
        return min(took)

    assert cpu(lambda: unit.hashes(ctx, a, b)) < 0.6 * cpu(lambda: W.span_hashes(ctx.astype(np.uint64), a, b))


def test_order_and_pairs():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 5000):
        k = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        k[: n // 2] = (k[: n // 2] & np.uint64(7)) + np.uint64(1 << 40)  # their tops are equal
        k, h = k[rng.integers(0, n, n)] if n else k, rng.integers(0, 5, n).astype(np.uint64)
        order, want = repeats._order(k, h), np.lexsort((h, k))
        assert sorted(order.tolist()) == list(range(n))
        assert (k[order] == k[want]).all() and (h[order] == h[want]).all() and (k[repeats._order(k)] == k[want]).all()
        at = np.unique(np.stack([k, h]), axis=1, return_index=True)[1]
        listed = at[rng.permutation(len(at))][: 2 * len(at) // 3]
        pairs = repeats._Pairs(k[listed], h[listed])
        where = {(int(k[i]), int(h[i])): p for p, i in enumerate(listed.tolist())}
        hit, which = pairs.keys.find(k)
        assert sorted(hit.tolist()) == np.flatnonzero(np.isin(k, k[listed])).tolist()
        assert pairs.find(which, h[hit]).tolist() == [where.get((int(k[i]), int(h[i])), -1) for i in hit.tolist()]


def test_radix_groups_of_many_starts():
    start = np.concatenate([np.arange(70000), np.arange(70000)[::-1]])
    data = np.full(140000 + 8, 5, np.uint8)
    member, group = suffixes.radix_groups(data, np.arange(140000), start, 8)
    assert len(member) == 140000 and (start[member[::2]] == start[member[1::2]]).all() and (group[::2] == group[1::2]).all()
    assert len(np.unique(group)) == 70000
