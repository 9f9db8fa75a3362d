"""Centroid clustering (Lloyd rounds over integer vectors) with an incremental distance matrix.

Every vector's row keeps its exact integer dot product with every centroid. A round does not
recompute them: a centroid that moved by ``d`` changes a vector's dot product by ``x . d``, which only
the nonzero components of ``d`` enter, and a centroid that stayed costs nothing. Squared distances are
``|x|^2 - 2 x.c + |c|^2`` in integers, so the argmin, and with it every round, is exact.

A round is one job over the rows of the last one's table: each task updates its rows' dot products,
assigns them and adds up its clusters' components, so no vector is shuffled and the size of a
cluster does not matter. The next table holds the rows and, in columns of their own, each task's sums
(one row per cluster and task); Spark adds those up, and the driver gets one row per cluster. Tables
lie in the shared checkpoint folder, so a lost executor costs its tasks only; a table is deleted when
the next one is there. When no centroid moves, the remaining rounds would change nothing and are
not run.

Defined cases: a vector that is null, of another length, or with a null or non-finite component gets
no row; rows that repeat a ``vec_id`` each count and each get a row (as first centroids, in the order of
their components); equal vectors are centroids of their own if their hashes come first, and the
smaller number wins their ties; fewer kept rows than centroids give as many centroids as rows; an empty
table gives an empty result; further columns are ignored. A component above 2^27 after scaling is
an error, as its squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm import vectors as V

DIM, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, 2

STATE = "vec_id long, x array<int>, dots array<long>, cluster int, distance long, of int, n long, inertia long, sums array<long>"
ROW, SUM = ("vec_id", "x", "dots", "cluster", "distance"), ("of", "n", "inertia", "sums")
TYPES = {"vec_id": pa.int64(), "x": pa.list_(pa.int32()), "dots": pa.list_(pa.int64()), "cluster": pa.int32(), "distance": pa.int64(),
         "of": pa.int32(), "n": pa.int64(), "inertia": pa.int64(), "sums": pa.list_(pa.int64())}

#: Integers below this are exact in doubles, whose matrix product is the fast one.
EXACT = 1 << 53


def first_centroids(kept: DataFrame, k: int = K, seed: int = SEED) -> list[tuple[int, ...]]:
    """The k vectors with the smallest sha256 of ``seed:vec_id``, in that order (at most k rows leave
    a task)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [tuple(r.x) for r in kept.orderBy(key.asc_nulls_last(), "x").limit(k).collect()]


def moves(old: np.ndarray, new: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centroid, components that changed, by how much), for the centroids that moved."""
    out = []
    for j, d in enumerate(new - old):
        at = np.flatnonzero(d)
        if len(at):
            out.append((j, at, d[at]))
    return out


def add_moves(dots: np.ndarray, x: np.ndarray, moved: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """Adds ``x . d`` to the dot products with every moved centroid. Doubles are used where every
    partial sum is an integer below 2^53, hence exact; else integers."""
    most = int(np.abs(x).max(initial=0))
    narrow = [m for m in moved if most * int(np.abs(m[2]).sum()) < EXACT]
    if narrow:
        d = np.zeros((x.shape[1], len(narrow)))
        for i, (_, at, by) in enumerate(narrow):
            d[at, i] = by
        rows = np.flatnonzero(d.any(axis=1))  # components that no centroid changed are left out
        dots[:, [j for j, _, _ in narrow]] += (x[:, rows].astype(np.float64) @ d[rows]).astype(np.int64)
    for j, at, by in moved:
        if most * int(np.abs(by).sum()) >= EXACT:
            dots[:, j] += x[:, at] @ by


def _round(moved: list, squares: np.ndarray, dim: int):
    """Task function: update the dot products, assign, add up."""
    k = len(squares)

    def record(values: dict, n: int) -> pa.RecordBatch:
        return pa.record_batch({c: values[c] if c in values else pa.nulls(n, t) for c, t in TYPES.items()})

    def run(batches):
        n, inertia, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = V.matrix(batch.column("x"))
            dots = V.matrix(batch.column("dots")).copy() if "dots" in batch.schema.names else np.zeros((len(x), k), np.int64)
            add_moves(dots, x, moved)
            far = (x * x).sum(axis=1)[:, None] - 2 * dots + squares[None, :]
            cluster = far.argmin(axis=1)  # the first of equal ones
            distance = far[np.arange(len(x)), cluster]
            n += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            found, at = np.unique(cluster[order], return_index=True)
            inertia[found] += np.add.reduceat(distance[order], at)
            sums[found] += np.add.reduceat(x[order], at, axis=0)
            yield record({"vec_id": batch.column("vec_id"), "x": batch.column("x").cast(TYPES["x"]), "dots": V.lists(dots, pa.int64()),
                          "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance, pa.int64())}, len(x))
        full = np.flatnonzero(n)
        if len(full):
            yield record({"of": pa.array(full, pa.int32()), "n": pa.array(n[full]), "inertia": pa.array(inertia[full]), "sums": V.lists(sums[full], pa.int64())}, len(full))

    return run


def _totals(table: DataFrame, dim: int) -> dict[int, tuple[int, int, list[int]]]:
    """cluster: (rows, inertia, component sums), added up by Spark; one row per cluster."""
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    added = table.filter(F.col("of").isNotNull()).groupBy("of").agg(
        F.sum("n").alias("n"), wide(F.col("inertia")).alias("inertia"), F.array(*[wide(F.col("sums")[i]) for i in range(dim)]).alias("sums")
    )
    return {r["of"]: (r["n"], int(r["inertia"]), [int(s) for s in r["sums"]]) for r in added.collect()}


def cluster(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE, k: int = K, rounds: int = ROUNDS, seed: int = SEED
) -> tuple[DataFrame, list[tuple[int, ...]], dict[int, tuple[int, int, list[int]]]]:
    """(rows, centroids, totals): ``rows`` has vec_id, x, cluster and distance of every kept vector
    after ``rounds`` rounds and a last assignment; ``totals`` maps each non-empty cluster to its
    (rows, inertia, component sums)."""
    spark = table.sparkSession
    tables = V.Tables(spark, "centroids")
    vector = F.col(vector_col)
    ok = (F.size(vector) == dim) & V.finite(vector)
    kept = table.filter(ok).select(F.col(id_col).cast("long").alias("vec_id"), V.quantised(vector, scale).alias("x"))
    now, name = tables.write(kept, "kept"), "kept"
    if not V.check(now, "x"):
        return now.select("vec_id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], {}
    at = np.array(first_centroids(now, k, seed), np.int64)
    moved = moves(np.zeros_like(at), at)
    for i in range(rounds + 1):
        source = now.select("vec_id", "x") if name == "kept" else now.filter(F.col("cluster").isNotNull()).select("vec_id", "x", "dots")
        now = tables.write(source.mapInArrow(_round(moved, (at * at).sum(axis=1), dim), STATE), f"round{i}")
        tables.drop(name)
        name, totals = f"round{i}", _totals(now, dim)
        if i == rounds:
            break
        new = at.copy()
        for j, (n, _, sums) in totals.items():
            new[j] = [s // n for s in sums]
        moved, at = moves(at, new), new
        if not moved:
            break
    rows = now.filter(F.col("cluster").isNotNull()).select("vec_id", "x", "cluster", "distance")
    return rows, [tuple(int(v) for v in c) for c in at], totals


def report(table: DataFrame) -> DataFrame:
    """The query's columns."""
    rows, centroids, totals = cluster(table)
    if not centroids:
        return rows.select("vec_id", "cluster", "distance", F.col("distance").alias("cluster_inertia"), F.col("distance").alias("inertia"), F.lit("").alias("centroid_sha256"))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    each = [totals.get(j, (0, 0, []))[1] for j in range(len(centroids))]
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return rows.select(
        "vec_id", "cluster", "distance", pick(each).cast("long").alias("cluster_inertia"), F.lit(sum(each)).cast("long").alias("inertia"), pick(digest).alias("centroid_sha256")
    )
