"""Vector code compression: a product quantiser over integer vectors whose nearest-entry search is
memoised by grid cells.

A vector is cut into equal consecutive parts, each with a codebook of its own. To assign a part, its
coarse cell (every component divided by ``cell``, floored) is looked up. For a new cell, the least and
the largest squared distance from any point of the cell's box to every codebook entry are added up
from small tables, one per component; an entry whose least distance is above the smallest of the
largest distances is dominated across the whole box and is nearest to no point in it. The entries that
are left are kept with the cell, and every later part in that cell is evaluated exactly against them
only. Domination is strict, so ties reach the exact evaluation, where the lower index wins.

A round is one job over the written integer vectors: tasks assign parts and add up their entries'
components (one row per part, entry and task); Spark adds those up and the driver gets the codebooks
(parts x entries, whatever the rows). No vector is shuffled, so equal vectors and hot labels do
not matter. The memory of a task is bounded by its Arrow batch, ``CACHE_CELLS`` cells (32 bytes of
entries each; the memo starts anew beyond that) and ``PAIRS`` evaluations at once.

Defined cases: a null vector, or one with a null or non-finite component, gets no row; vectors have
one length, the most frequent one (the longer of equally frequent ones), others get no row; a length
that the parts don't divide is cut at floor(i * length / parts); rows that repeat a ``vec_id`` each get
a row (as first entries, in the order of their components); null ids come last; fewer kept rows than
entries make a smaller codebook; null labels are one label; an empty table gives an empty result;
further columns are ignored. A component above 2^27 after scaling is an error, as its squared
distances would not fit a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm import vectors as V
from tastemap.session import checked_broadcast

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4

CELL = 64  # edge of a cell, in units of the integer components
CACHE_CELLS = 50_000
PAIRS = 1 << 18  # (part, entry) pairs evaluated at once
MAX_BROADCAST_LABELS = 100_000


class Cells:
    """The entries of one codebook that can be nearest somewhere in a cell, by cell."""

    def __init__(self, book: np.ndarray, cell: int = CELL):
        self.book, self.cell = book, cell
        self.memo: dict[bytes, np.ndarray] = {}

    def _bounds(self, cells: np.ndarray) -> np.ndarray:
        """Packed rows of the entries not dominated across each cell's box."""
        least = np.zeros((len(cells), len(self.book)), np.int64)
        largest = np.zeros_like(least)
        for d in range(cells.shape[1]):
            values, at = np.unique(cells[:, d], return_inverse=True)
            low = values[:, None] * self.cell - self.book[None, :, d]  # box edges seen from the entry
            high = low + (self.cell - 1)
            near = np.maximum(np.maximum(low, -high), 0)
            far = np.maximum(np.abs(low), np.abs(high))
            least += (near * near)[at]
            largest += (far * far)[at]
        return np.packbits(least <= largest.min(axis=1)[:, None], axis=1)

    def entries(self, parts: np.ndarray) -> np.ndarray:
        """For every part, whether each entry has to be evaluated (n x entries)."""
        cells, at = np.unique(np.floor_divide(parts, self.cell), axis=0, return_inverse=True)
        keys = [c.tobytes() for c in cells]
        new = [i for i, key in enumerate(keys) if key not in self.memo]
        if len(self.memo) + len(new) > CACHE_CELLS:
            self.memo, new = {}, list(range(len(keys)))
        if new:
            for i, row in zip(new, self._bounds(cells[new])):
                self.memo[keys[i]] = row
        packed = np.stack([self.memo[key] for key in keys])
        return np.unpackbits(packed, axis=1, count=len(self.book)).astype(bool)[at.reshape(-1)]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each part's nearest entry; ties go to the lower index."""
        index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        step = max(1, PAIRS // max(1, len(self.book)))
        for s in range(0, len(parts), step):
            some = parts[s : s + step]
            row, entry = np.nonzero(self.entries(some))  # ordered by row, then entry
            diff = some[row] - self.book[entry]
            far = (diff * diff).sum(axis=1)
            first = np.searchsorted(row, np.arange(len(some)))
            least = np.minimum.reduceat(far, first)
            hit = np.flatnonzero(far == least[row])
            at = hit[np.searchsorted(row[hit], np.arange(len(some)))]
            index[s : s + step], distance[s : s + step] = entry[at], least
        return index, distance


def cuts(dim: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


SUMS = "part int, entry int, n long, sums array<long>"


def _add_up(books: list[np.ndarray], bounds: list[tuple[int, int]]):
    """Task function of a round: (part, entry, n, component sums) of the task's rows."""

    def run(batches):
        cells = [Cells(b) for b in books]
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = V.matrix(batch.column("x"))
            for p, (a, b) in enumerate(bounds):
                index, _ = cells[p].nearest(x[:, a:b])
                n[p] += np.bincount(index, minlength=len(n[p]))
                order = np.argsort(index, kind="stable")
                found, at = np.unique(index[order], return_index=True)
                if b > a:
                    sums[p][found] += np.add.reduceat(x[order, a:b], at, axis=0)
        for p in range(len(books)):
            used = np.flatnonzero(n[p])
            if len(used):
                yield pa.record_batch({"part": pa.array(np.full(len(used), p), pa.int32()), "entry": pa.array(used, pa.int32()),
                                       "n": pa.array(n[p][used]), "sums": V.lists(sums[p][used], pa.int64())})

    return run


def _encode(books: list[np.ndarray], bounds: list[tuple[int, int]]):
    """Task function of the last assignment: adds ``codes`` (an index per part) and ``error``."""

    def run(batches):
        cells = [Cells(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = V.matrix(batch.column("x"))
            found = [cells[p].nearest(x[:, a:b]) for p, (a, b) in enumerate(bounds)]
            codes, error = np.stack([i for i, _ in found], axis=1), sum(d for _, d in found)
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "label": batch.column("label"), "codes": V.lists(codes, pa.int32()), "error": pa.array(error, pa.int64())})

    return run


def compress(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE, parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, dim: int | None = None,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): vec_id, label (as string), codes and error of every kept row, and one
    codebook per part (entries x components)."""
    tables = V.Tables(table.sparkSession, "codes")
    kept = table.filter(V.finite(F.col(vector_col)))
    if dim is None:
        top = kept.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
        dim = top["d"] if top else 0
    rows = kept.filter(F.size(vector_col) == dim).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), V.quantised(F.col(vector_col), scale).alias("x")
    )
    rows = tables.write(rows, "kept")
    V.check(rows, "x")
    bounds = cuts(dim, parts)
    first = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([r.x for r in first], np.int64).reshape(len(first), dim)
    books = [start[:, a:b].copy() for a, b in bounds]
    if len(first):
        for _ in range(rounds):
            each = rows.select("x").mapInArrow(_add_up(books, bounds), SUMS)
            wide = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(max(b - a for a, b in bounds))]
            for r in each.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*wide).alias("sums")).collect():
                a, b = bounds[r.part]
                books[r.part][r.entry] = [int(s) // r.n for s in r.sums[: b - a]]
    out = rows.mapInArrow(_encode(books, bounds), "vec_id long, label string, codes array<int>, error long")
    out = tables.write(out, "codes")
    tables.drop("kept")
    return out, books


def report(table: DataFrame) -> DataFrame:
    """The query's columns."""
    rows, books = compress(table)
    digest = hashlib.sha256(",".join(str(int(v)) for book in books for v in book.reshape(-1)).encode()).hexdigest()
    # one row per label, so a hot label is only on the other side of the join
    errors = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(checked_broadcast(errors, MAX_BROADCAST_LABELS, "labels"), F.col("label").eqNullSafe(F.col("of")), "left")
    code = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
