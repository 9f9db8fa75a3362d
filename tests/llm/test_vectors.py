"""Centroid clustering and vector codes against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tastemap.llm import centroids, codes
from tests.llm.conftest import clashing

VECS = "vec_id long, embedding array<float>, label int"


def floor_scaled(v, scale):
    return [int(np.floor(scale * float(np.float32(x)))) for x in v]


def finite(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    hot = [float(x) for x in rng.normal(0, 0.1, 64)]
    out = [(i, [float(x) for x in rng.normal(i % 3, 0.2, 64)], i % 4 or None) for i in range(330)]
    out += [(1000 + i, hot, 1) for i in range(150)]  # a third of all rows are one vector
    out += [(5, out[5][1], 2), (5, out[6][1], 2)]  # repeated ids, one row repeated
    out += [(2000, None, 1), (2001, [float("nan")] * 64, 1), (2002, [1.0] * 63 + [None], 1), (2003, [float("inf")] + [0.0] * 63, 1)]
    out += [(2004, [1.0] * 8, 1), (2005, [], None), (2006, [-300.0] * 64, 3), (2007, [0.0] * 64, 3)]
    return out


def brute_centroids(rows, k=40, rounds=5):
    kept = [(i, floor_scaled(v, 256)) for i, v, _ in rows if finite(v) and len(v) == 64]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in kept[:k]]
    x = np.array([v for _, v in kept], object)
    for r in range(rounds + 1):
        d = np.stack([((x - np.array(c, object)) ** 2).sum(axis=1) for c in cents], axis=1)
        a = [min(range(len(cents)), key=lambda j: (row[j], j)) for row in d]
        if r < rounds:
            for j in range(len(cents)):
                mine = [v for (_, v), c in zip(kept, a) if c == j]
                if mine:
                    cents[j] = [sum(c) // len(mine) for c in zip(*mine)]
    dist = [int(row[j]) for row, j in zip(d, a)]
    per = Counter()
    for j, s in zip(a, dist):
        per[j] += s
    return Counter((i, j, s, per[j], sum(dist), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for (i, _), j, s in zip(kept, a, dist))


def result(df):
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_centroids_match_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, VECS).repartition(parts)
    assert result(centroids.report(clashing(df).withColumn("x", df.vec_id).withColumn("cluster", df.vec_id))) == brute_centroids(rows)


def test_fewer_rows_than_centroids_and_none(spark, rows):
    few = rows[:5] + rows[-4:]
    assert result(centroids.report(spark.createDataFrame(few, VECS))) == brute_centroids(few)
    assert centroids.report(spark.createDataFrame([], VECS)).collect() == []
    same = [(i, [0.5] * 64, 0) for i in range(60)]  # equal vectors: the first centroid takes them all
    assert {r.cluster for r in centroids.report(spark.createDataFrame(same, VECS)).collect()} == {0}


def test_moves_are_the_changed_components_and_exact():
    rng = np.random.default_rng(1)
    old, x = rng.integers(-9, 9, (6, 8)), rng.integers(-(1 << 27), 1 << 27, (50, 8))
    new = old.copy()
    new[1, 3] += 5
    new[4, [0, 7]] -= 1 << 27
    moved = centroids.moves(old, new)
    assert [(j, list(at)) for j, at, _ in moved] == [(1, [3]), (4, [0, 7])]
    dots = x @ old.T
    centroids.add_moves(dots, x, moved)
    assert (dots == x @ new.T).all()


def test_out_of_range_component_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 64, 0), (2, [0.0] * 64, 0)], VECS)
    for report in (centroids.report, codes.report):
        with pytest.raises(ValueError, match="fit a long"):
            report(df)


def test_tables_of_earlier_rounds_are_deleted(spark, rows):
    import os

    df, _, _ = centroids.cluster(spark.createDataFrame(rows, VECS))
    path = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert len([n for n in os.listdir(os.path.dirname(os.path.dirname(path))) if not n.startswith(".")]) == 1


def brute_codes(rows, entries=256, rounds=4, dim=64):
    kept = sorted(((i, floor_scaled(v, 1024), lab) for i, v, lab in rows if finite(v) and len(v) == dim), key=lambda r: r[:2])
    out, books = [["", 0] for _ in kept], []
    for p in range(4):
        a, b = p * dim // 4, (p + 1) * dim // 4
        x = np.array([v[a:b] for _, v, _ in kept], np.int64).reshape(len(kept), b - a)
        book = [list(map(int, v)) for v in x[:entries]]
        for r in range(rounds + 1):
            d = np.stack([((x - np.array(c)) ** 2).sum(axis=1) for c in book], axis=1)
            at = d.argmin(axis=1)
            if r < rounds:
                for j in range(len(book)):
                    if (at == j).any():
                        book[j] = [int(s) // int((at == j).sum()) for s in x[at == j].sum(axis=0)]
        for o, i, s in zip(out, at, d.min(axis=1)):
            o[0], o[1] = o[0] + f"{i:02x}", o[1] + int(s)
        books += [v for c in book for v in c]
    per = Counter()
    for (_, _, lab), (_, e) in zip(kept, out):
        per[lab] += e
    h = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return Counter((i, c, e, per[lab], h) for (i, _, lab), (c, e) in zip(kept, out))


def coded(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_codes_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, VECS).repartition(5)
    assert coded(codes.report(clashing(df).withColumn("code", df.vec_id).withColumn("of", df.vec_id))) == brute_codes(rows)


def test_codes_of_few_and_short_vectors(spark):
    rng = np.random.default_rng(8)
    few = [(i, [float(v) for v in rng.integers(-1, 2, 6)], None) for i in range(9)]  # 6 components: parts of 1, 2, 1 and 2
    assert coded(codes.report(spark.createDataFrame(few, VECS))) == brute_codes(few, dim=6)
    assert codes.report(spark.createDataFrame([], VECS)).collect() == []
    assert codes.report(spark.createDataFrame([(1, None, 1), (2, [None], 1)], VECS)).collect() == []


@pytest.mark.parametrize("cell", [1, 16, 64, 1000])
def test_cells_keep_every_nearest_entry(cell, monkeypatch):
    rng = np.random.default_rng(cell)
    book = rng.integers(-300, 300, (70, 5))
    book[9] = book[3]  # a tie
    parts = np.concatenate([rng.integers(-400, 400, (600, 5)), book, np.repeat(book[3:4], 300, axis=0)])
    d = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    monkeypatch.setattr(codes, "PAIRS", 1000)
    monkeypatch.setattr(codes, "CACHE_CELLS", 200)  # the memo starts anew now and then
    cells = codes.Cells(book, cell)
    index, distance = cells.nearest(parts)
    assert (index == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    assert len(cells.memo) <= 200
    if cell < 1000:
        assert cells.entries(parts[:1]).sum() < len(book)  # dominated entries are not evaluated
