"""Scoring users against items by dot product or Euclidean distance.

Items are cut into blocks with a bound each: for dot products by descending norm (Cauchy-Schwarz),
for distances by halving along the widest axis (centroid and radius). A task holds its users' best
lists and skips every block whose bound cannot reach a user's k-th value, so the user x item grid is
neither shuffled nor, where bounds are tight, computed. A user row is never copied: an Arrow batch of
users meets all item blocks inside its task, with its lists already complete, so no merge follows.

Blocks are scored in single precision first. That score, with a bound of its error, only tells which
pairs can matter; those are scored again in double precision (:func:`_pair_keys`), and only these
scores are ranked, counted and returned.

Item blocks are broadcast when their counted bytes are at most ``max_broadcast_bytes``. A larger item
table is range-partitioned into segments of that size (by norm, or along the widest axis) and scored
in rounds, one broadcast segment at a time; the lists, and with them the thresholds, are written
between the rounds. Only pairs of the segment's items are packed as a user's seen list.

:func:`rank_targets` gives the rank of given (user, item) pairs in the user's full order without
sorting that order: each segment adds the number of unseen items that score above the pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.ranking import top_k
from tastemap.functions.vectors import sq_dist
from tastemap.operators.masks import unseen
from tastemap.schema import ITEM, SCORE, USER
from tastemap.session import cut_lineage, materialize

OUT_SCHEMA = f"{USER} int, {ITEM} int, {SCORE} double"
BLOCK_ITEMS = 1_024
MAX_BROADCAST_BYTES = 128 << 20  # counted item bytes that are broadcast at once
TASK_CELLS = 1 << 30  # users x items of one task, where there are enough
EVEN_TASKS = 1_000  # below so many tasks each has a quarter of that, so that no core waits long for the last ones
MANY_ITEMS = 8_192  # fewer are scored in the tasks that hold the users
CODES = 32_000  # rough keys that targets are compared with are whole numbers up to so much
SEEN_CODE = 32_767  # that of a seen item, after all others
MANY_TARGETS = 64  # a user with more targets has a block's items sorted instead
CELLS = 1 << 22  # users x items scored at once inside a task
CHUNK_USERS = 512


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of one length as a matrix, without per-row objects."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


@dataclass
class Items:
    """One segment of items in blocks: rows ``starts[b]:starts[b + 1]`` of ``ids`` and ``mat`` are block b,
    in id order. ``order`` sorts all ids."""

    ids: np.ndarray
    mat: np.ndarray
    starts: np.ndarray
    centroid: np.ndarray
    radius: np.ndarray
    norm: np.ndarray  # largest of each block
    order: np.ndarray

    @staticmethod
    def of(ids: np.ndarray, mat: np.ndarray, metric: str, block_items: int) -> Items:
        if not len(ids):
            groups = []
        elif metric == "dot":
            by = np.lexsort((ids, -np.sqrt((mat * mat).sum(axis=1))))
            groups = [by[s : s + block_items] for s in range(0, len(by), block_items)]
        else:
            groups, todo = [], [np.arange(len(ids))]
            while todo:
                rows = todo.pop()
                if len(rows) <= block_items:
                    groups.append(rows)
                    continue
                axis = int(np.ptp(mat[rows], axis=0).argmax())
                rows = rows[np.lexsort((ids[rows], mat[rows, axis]))]
                todo += [rows[len(rows) // 2 :], rows[: len(rows) // 2]]
        groups = [g[np.argsort(ids[g], kind="stable")] for g in groups]
        rows = np.concatenate(groups) if groups else np.zeros(0, np.int64)
        ids, mat = ids[rows], np.ascontiguousarray(mat[rows])
        if not len(ids):
            none = np.zeros(0)
            return Items(ids, mat, np.zeros(1, np.int64), mat, none, none, rows)
        starts = np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(np.int64)
        parts = [mat[a:b] for a, b in zip(starts[:-1], starts[1:])]
        centroid = np.array([p.mean(axis=0) for p in parts]).reshape(len(parts), mat.shape[1])
        radius = np.array([np.sqrt(((p - c) ** 2).sum(axis=1).max()) for p, c in zip(parts, centroid)])
        norm = np.array([np.sqrt((p * p).sum(axis=1).max()) for p in parts])
        return Items(ids, mat, starts, centroid, radius, norm, np.argsort(ids, kind="stable"))

    def single(self, metric: str) -> tuple[np.ndarray, float]:
        """What :class:`_Rough` multiplies users with, in single precision, and its longest row; kept in the worker."""
        if getattr(self, "_single", None) is None:
            half = [] if metric == "dot" else [0.5 * (self.mat * self.mat).sum(axis=1)[:, None]]
            wide = np.hstack([-self.mat, *half])
            top = float(np.sqrt((wide * wide).sum(axis=1).max(initial=0.0)))
            with np.errstate(over="ignore"):
                self._single = wide.astype(np.float32), top
        return self._single

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each wanted id, -1 where there is none."""
        if not len(self.ids) or not len(wanted):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.ids, wanted, sorter=self.order), len(self.ids) - 1)
        rows = self.order[at]
        return np.where(self.ids[rows] == wanted, rows, -1)


def _keys(metric: str, u: np.ndarray, v: np.ndarray, digits: int | None) -> np.ndarray:
    """users x items, smaller is better: the negated product, or the distance."""
    prod = u @ v.T
    if metric == "dot":
        value = prod
    else:
        value = np.sqrt(np.maximum((u * u).sum(axis=1)[:, None] + (v * v).sum(axis=1)[None, :] - 2.0 * prod, 0.0))
    if digits is not None:
        value = np.round(value, digits)
    return -value if metric == "dot" else value


def _pair_keys(metric: str, u: np.ndarray, v: np.ndarray, digits: int | None) -> np.ndarray:
    """The key of each row pair of ``u`` and ``v``; it does not depend on what else is scored."""
    if metric == "dot":
        value = np.einsum("ij,ij->i", u, v)
    else:
        diff = u - v
        value = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    if digits is not None:
        value = np.round(value, digits)
    return -value if metric == "dot" else value


class _Rough:
    """Single-precision keys of a chunk of users against blocks: the negated product, or half the squared
    distance less half the user's squared length. ``err`` bounds their error."""

    def __init__(self, metric: str, u: np.ndarray, items: Items, digits: int | None):
        self.metric, self.items, self.step = metric, items, 0.0 if digits is None else 10.0**-digits
        self.half = 0.0 if metric == "dot" else 0.5 * (u * u).sum(axis=1)
        ones = [] if metric == "dot" else [np.ones((len(u), 1))]
        wide = np.hstack([u, *ones])
        self.length = length = np.sqrt((wide * wide).sum(axis=1))
        with np.errstate(over="ignore"):
            self.u, (self.v, top) = wide.astype(np.float32), items.single(metric)
        dim = wide.shape[1]
        self.err = (dim + 8) * 2.0**-23 * length * top + dim * 1e-37 * (1.0 + length + top)
        self.usable = bool(np.isfinite(self.err).all() and (length * top < 1e30).all() and top < 1e30)
        most = int(np.diff(items.starts).max(initial=0))
        self.buf = np.empty(len(u) * most, np.float32)

    def block(self, b: int, rows: np.ndarray | slice, scale: np.ndarray | None = None) -> np.ndarray:
        s, e = self.items.starts[b], self.items.starts[b + 1]
        u = self.u[rows] if scale is None else self.u[rows] * scale[:, None]
        out = self.buf[: len(u) * (e - s)].reshape(len(u), e - s)
        return np.matmul(u, self.v[s:e].T, out=out)

    def scale(self, b: int) -> np.ndarray:
        """For each user a power of two that brings the block's rough keys between -``CODES`` and ``CODES``; times such a
        power, they and their errors stay what they are."""
        norm = self.items.norm[b]
        reach = self.length * (norm if self.metric == "dot" else np.hypot(norm, 0.5 * norm * norm))
        return np.exp2(np.minimum(np.floor(np.log2(CODES / np.maximum(reach, 1e-30))), 40.0)).astype(np.float32)

    def at_most(self, key: np.ndarray, rows) -> np.ndarray:
        """A rough key that no pair of (exact, rounded) key ``key`` or less exceeds."""
        return self._bound(key + self.step, rows) + self._err(rows)

    def below(self, key: np.ndarray, rows) -> np.ndarray:
        """A pair of smaller rough key has an exact, rounded key under ``key``."""
        return self._bound(key - self.step, rows) - self._err(rows)

    def reach(self, rough: np.ndarray, rows) -> np.ndarray:
        """A rough key that no pair exceeds whose exact key, when rounded, is that of a pair of rough key ``rough``."""
        if self.metric == "dot":
            return rough + 2.0 * self._err(rows) + 2.0 * self.step
        far = np.sqrt(2.0 * np.maximum(rough + self._err(rows) + self.half[rows], 0.0))
        return self._bound(far + 2.0 * self.step, rows) + 2.0 * self._err(rows)

    def _bound(self, key: np.ndarray, rows) -> np.ndarray:
        if self.metric == "dot":
            return key
        half = self.half[rows] if key.ndim == 1 else self.half[rows][:, None]
        return np.where(key < 0.0, -np.inf, 0.5 * key * np.abs(key) - half)

    def _err(self, rows):
        return self.err[rows]


def _single(x: np.ndarray, up: bool) -> np.ndarray:
    """Double bounds as single ones, not lower (``up``) or not higher."""
    with np.errstate(over="ignore"):
        y = x.astype(np.float32)
    return np.nextafter(y, np.float32(np.inf if up else -np.inf))


def _where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a contiguous boolean matrix with few true cells, eight cells a step."""
    flat = mask.reshape(-1)
    n = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:n].view(np.uint64))
    at = (words[:, None] * 8 + np.arange(8)).reshape(-1)
    at = np.concatenate([at[flat[at]], n + np.flatnonzero(flat[n:])])
    return np.divmod(at, max(1, mask.shape[1]))


def _floors(metric: str, u: np.ndarray, items: Items, digits: int | None) -> np.ndarray:
    """users x blocks: a key that no item of the block is below, less a margin for rounding."""
    length = np.sqrt((u * u).sum(axis=1))
    if metric == "dot":
        low = -np.minimum(length[:, None] * items.norm[None, :], u @ items.centroid.T + length[:, None] * items.radius[None, :])
    else:
        c = items.centroid
        far = np.sqrt(np.maximum((u * u).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2.0 * (u @ c.T), 0.0))
        low = np.maximum(far - items.radius[None, :], 0.0)
    scale = (length[:, None] + 1.0) * (items.norm[None, :] + 1.0) if metric == "dot" else length[:, None] + items.norm[None, :] + 1.0
    return low - 1e-7 * scale - (0.0 if digits is None else 10.0**-digits)


NONE = np.iinfo(np.int64).max


class _Seen:
    """The seen items of a chunk of users, by block."""

    def __init__(self, col: pa.Array, items: Items):
        rows = np.repeat(np.arange(len(col)), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        at = items.find(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        rows, at = rows[at >= 0], at[at >= 0]
        order = np.argsort(at, kind="stable")
        self.rows, self.at, self.ids, self.order = rows[order], at[order], items.ids, items.order
        self.cut = np.searchsorted(self.at, items.starts)

    def smaller(self, row: np.ndarray, item: np.ndarray) -> np.ndarray:
        """For each (row, item), the row's seen items of a smaller id."""
        pos = np.empty(len(self.order), np.int64)
        pos[self.order] = np.arange(len(pos))
        sorted_ids, n = self.ids[self.order], len(pos) + 1
        mine = np.sort(self.rows * n + pos[self.at])
        return np.searchsorted(mine, row * n + np.searchsorted(sorted_ids, item)) - np.searchsorted(mine, row * n)

    def mask(self, key: np.ndarray, block: int, start: int, among: np.ndarray | None = None, value: float = np.inf) -> None:
        """Sets the keys of seen items to ``value``; ``among`` maps users to rows of ``key`` (-1: none)."""
        a, b = self.cut[block], self.cut[block + 1]
        rows, cols = self.rows[a:b], self.at[a:b] - start
        if among is not None:
            rows, cols = among[rows], cols[among[rows] >= 0]
            rows = rows[rows >= 0]
        key[rows, cols] = value


def _chunks(batch: pa.RecordBatch, step: int) -> Iterator[pa.RecordBatch]:
    for s in range(0, batch.num_rows, step):
        yield batch.slice(s, step)


def _candidates(rough: _Rough, seen: _Seen, u: np.ndarray, b: int, go: np.ndarray, key: np.ndarray, n: int, m: int):
    """(users, item rows) of the block that may enter the lists of the users ``go``."""
    s, e = rough.items.starts[b], rough.items.starts[b + 1]
    if not rough.usable:  # numbers out of single precision's range
        near = np.zeros((len(go), e - s), np.float32)
        bound = np.full(len(go), np.inf)
    else:
        near, bound = rough.block(b, go if len(go) < m else slice(None)), rough.at_most(key[go, n - 1], go)
    among = np.full(m, -1)
    among[go] = np.arange(len(go))
    seen.mask(near, b, s, among)
    short = np.flatnonzero(np.isinf(key[go, n - 1]))
    if len(short) and rough.usable and e - s > n:  # the list isn't full: the block's own n-th gives the bound
        bound[short] = rough.reach(np.partition(near[short], n - 1, axis=1)[:, n - 1].astype(np.float64), go[short])
    rows, cols = _where(near <= _single(bound, True)[:, None])
    real = ~np.isinf(near[rows, cols])  # an unseen item's rough key is finite
    return go[rows[real]], s + cols[real]


def _merge(key: np.ndarray, ids: np.ndarray, n: int, rows: np.ndarray, cols: np.ndarray, metric: str, u: np.ndarray, items: Items, digits: int | None) -> None:
    """Puts the pairs (row of ``u``, row of ``items``) into the rows' lists."""
    for s in range(0, len(rows), PAIRS):
        r, c = rows[s : s + PAIRS], cols[s : s + PAIRS]
        k, i = _pair_keys(metric, u[r], items.mat[c], digits), items.ids[c]
        enters = (k < key[r, n - 1]) | ((k == key[r, n - 1]) & (i < ids[r, n - 1]))
        r, k, i = r[enters], k[enters], i[enters]
        if not len(r):
            continue
        hit, r = np.unique(r, return_inverse=True)
        r = np.concatenate([np.repeat(np.arange(len(hit)), n), r])
        k, i = np.concatenate([key[hit].reshape(-1), k]), np.concatenate([ids[hit].reshape(-1), i])
        order = np.lexsort((i, k, r))
        r, k, i = r[order], k[order], i[order]
        keep = np.arange(len(r)) - np.searchsorted(r, np.arange(len(hit)))[r] < n
        key[hit], ids[hit] = k[keep].reshape(len(hit), n), i[keep].reshape(len(hit), n)


PAIRS = 1 << 18  # pairs scored exactly at once


def _best(metric: str, n: int, digits: int | None, bc, stats=None):
    """Task function: every user's n best unseen items of the segment, merged with the lists that the
    user brings. ``stats`` (tests) counts user-block pairs scored and skipped."""

    def run(batches):
        items = bc.value
        for batch in batches:
            for part in _chunks(batch, CHUNK_USERS):
                u, m = _matrix(part.column("features")), part.num_rows
                key, ids = np.full((m, n), np.inf), np.full((m, n), NONE)
                if "best" in part.schema.names:
                    best = part.column("best")
                    have = best.value_lengths().to_numpy(zero_copy_only=False)
                    rows = np.repeat(np.arange(m), have)
                    cols = np.arange(len(rows)) - np.repeat(np.cumsum(have) - have, have)
                    key[rows, cols] = part.column("keys").flatten().to_numpy(zero_copy_only=False)
                    ids[rows, cols] = best.flatten().to_numpy(zero_copy_only=False)
                seen = _Seen(part.column("seen"), items)
                low = _floors(metric, u, items, digits) if len(items.ids) else np.zeros((m, 0))
                rough = _Rough(metric, u, items, digits) if low.size else None
                steps = []
                if low.size:  # every user's most promising block first: it gives the lists their thresholds
                    first = low.argmin(axis=1)
                    steps = [(b, np.flatnonzero(first == b)) for b in np.unique(first)]
                    steps += [(b, np.flatnonzero(first != b)) for b in np.argsort(low.min(axis=0), kind="stable")]
                for b, among in steps:
                    go = among[low[among, b] <= key[among, n - 1]]
                    if stats is not None:
                        stats["scored"] += len(go)
                        stats["skipped"] += len(among) - len(go)
                    if not len(go):
                        continue
                    found = _candidates(rough, seen, u, b, go, key, n, m)
                    _merge(key, ids, n, *found, metric, u, items, digits)
                yield part.column("id"), ids, key

    return run


def _as_rows(metric: str, found):
    """One row per user and kept item, with its rank."""

    def run(batches):
        for uid, ids, key in found(batches):
            rows, cols = np.nonzero(ids != NONE)
            value = -key[rows, cols] if metric == "dot" else key[rows, cols]
            yield pa.record_batch(
                {
                    USER: pa.array(uid.to_numpy(zero_copy_only=False)[rows].astype(np.int32)),
                    ITEM: pa.array(ids[rows, cols].astype(np.int32)),
                    SCORE: pa.array(value + 0.0),
                    "rank": pa.array((cols + 1).astype(np.int64)),
                }
            )

    return run


def _as_lists(found):
    """One row per user with its list, for the next round."""

    def run(batches):
        for uid, ids, key in found(batches):
            full = ids != NONE
            ends = np.concatenate([[0], np.cumsum(full.sum(axis=1))]).astype(np.int32)
            lists = lambda a, t: pa.ListArray.from_arrays(pa.array(ends), pa.array(a[full], t))
            yield pa.record_batch({"id": uid.cast(pa.int64()), "best": lists(ids, pa.int64()), "keys": lists(key, pa.float64())})

    return run


def _all(metric: str, digits: int | None, bc):
    """Task function: every unseen pair of the segment."""

    def run(batches):
        items = bc.value
        step = max(1, CELLS // max(1, len(items.ids)))
        for batch in batches:
            for part in _chunks(batch, step):
                u, uid, seen = _matrix(part.column("features")), part.column("id").to_numpy(zero_copy_only=False), _Seen(part.column("seen"), items)
                for b, (s, e) in enumerate(zip(items.starts[:-1], items.starts[1:])):
                    key = _keys(metric, u, items.mat[s:e], digits)
                    seen.mask(key, b, s)
                    rows, cols = np.nonzero(~np.isinf(key))
                    value = -key[rows, cols] if metric == "dot" else key[rows, cols]
                    yield pa.record_batch(
                        {USER: pa.array(uid[rows].astype(np.int32)), ITEM: pa.array(items.ids[s:e][cols].astype(np.int32)), SCORE: pa.array(value + 0.0)}
                    )

    return run


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").cast("long").alias("id"), F.transform("features", lambda x: x.cast("double")).alias("features"))


@dataclass
class _Segments:
    """Items by segment: one broadcast, or several of bounded size."""

    items: DataFrame  # id, features[, seg]
    metric: str
    block_items: int
    n_items: int
    n: int = 1

    @staticmethod
    def of(items: DataFrame, metric: str, block_items: int, max_bytes: int) -> _Segments:
        if metric not in ("dot", "euclidean"):
            raise ValueError(f"unknown metric {metric!r}")
        items = _doubles(items)
        n_items, dim = items.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
        per = max(block_items, max_bytes // (8 * max(1, dim or 0)))
        if n_items <= per:
            return _Segments(items, metric, block_items, n_items)
        if metric == "dot":
            key = -F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x)
        else:
            spread = items.agg(*[F.max(F.col("features")[d]) - F.min(F.col("features")[d]) for d in range(dim)]).first()
            key = F.col("features")[int(np.argmax(spread))]
        n = -(-n_items // per)
        ranged = items.withColumn("_k", key).repartitionByRange(n, "_k", "id").withColumn("seg", F.spark_partition_id()).drop("_k")
        return _Segments(materialize(ranged, "items"), metric, block_items, n_items, n)

    def load(self, s: int):
        """Segment ``s`` as a broadcast."""
        rows = self.items if self.n == 1 else self.items.filter(F.col("seg") == s)
        table = rows.select("id", "features").toArrow()
        mat = _matrix(table.column("features")) if table.num_rows else np.zeros((0, 0))
        built = Items.of(table.column("id").to_numpy().astype(np.int64), mat, self.metric, self.block_items)
        return self.items.sparkSession.sparkContext.broadcast(built)

    def with_seen(self, users: DataFrame, seen: DataFrame | None, s: int) -> DataFrame:
        """``users`` with the items of the segment that each has seen, as a list no longer than it."""
        if seen is None:
            return users.withColumn("seen", F.array().cast("array<bigint>"))
        pairs = seen.select(F.col(USER).cast("long").alias("id"), F.col(ITEM).cast("long").alias("_i"))
        if self.n > 1:
            mine = self.items.filter(F.col("seg") == s).select(F.col("id").alias("_i"))
            pairs = pairs.join(F.broadcast(mine), "_i", "left_semi")
        lists = pairs.groupBy("id").agg(F.collect_set("_i").alias("seen"))
        return users.join(lists, "id", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<bigint>")))


def _tasks(cells: int) -> int:
    return max(-(-cells // TASK_CELLS), min(EVEN_TASKS, -(-4 * cells // TASK_CELLS)))


def _spread(rows: DataFrame, n_users: int, n_items: int) -> DataFrame:
    """Users dealt over tasks of at most ``TASK_CELLS`` cells."""
    n = _tasks(n_users * n_items)
    return rows.repartition(n, "id") if n > 1 else rows


def _users(users: DataFrame, segments: _Segments) -> tuple[DataFrame, int]:
    """Users, written once where several rounds read them, and how many there are (0: the items are too few to
    matter)."""
    u = _doubles(users)
    if segments.n > 1:
        u = materialize(u, "users")
    return u, u.count() if segments.n_items > MANY_ITEMS else 0


def score_users(
    users: DataFrame,
    items: DataFrame,
    metric: str = "dot",
    top_n: int | None = None,
    block_items: int = BLOCK_ITEMS,
    digits: int | None = None,
    seen: DataFrame | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Score every user (``id, features``) against every item (``id, features``) not in ``seen``.

    ``metric``: ``"dot"`` (higher first) or ``"euclidean"`` (nearer first; score = distance).
    ``top_n``: keep each user's best n, with their ``rank``; None keeps all pairs. Ties go to the smaller
    item id. ``digits`` rounds scores before ranking. ``seen`` holds (user, item) pairs.
    """
    segments = _Segments.of(items, metric, block_items, max_broadcast_bytes)
    u, n_users = _users(users, segments)
    if top_n is None:
        out = None
        for s in range(segments.n):
            part = segments.with_seen(u, seen, s).mapInArrow(_all(metric, digits, segments.load(s)), OUT_SCHEMA)
            out = part if out is None else out.unionByName(part)
        return out
    lists = None
    for s in range(segments.n):
        rows = segments.with_seen(u, seen, s)
        if lists is not None:
            rows = rows.join(lists, "id")
        rows = _spread(rows, n_users, segments.n_items // segments.n)
        found = _best(metric, top_n, digits, segments.load(s))
        if s == segments.n - 1:
            return rows.mapInArrow(_as_rows(metric, found), OUT_SCHEMA + ", rank long")
        lists = materialize(rows.mapInArrow(_as_lists(found), "id long, best array<long>, keys array<double>"), "lists")


def dot_scores(users: DataFrame, items: DataFrame, seen: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """All user x item dot products, minus pairs in ``seen`` (an all-pairs result: for small catalogues)."""
    return score_users(users, items, "dot", digits=digits, seen=seen)


def topk_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, metric: str = "dot", digits: int | None = None, **blocks
) -> DataFrame:
    """Exact top-k unseen items per user, with their rank: min(k, number of unseen items) rows."""
    return score_users(users, items, metric, top_n=k, digits=digits, seen=seen, **blocks)


def _counts(metric: str, digits: int | None, bc, known: bool):
    """Task function: for each target of a user, the unseen items of the segment above it, those with a
    smaller id, and how many there are. ``known``: the targets bring their keys; else the targets'
    keys are read off the segment."""

    def run(batches):
        items = bc.value
        sorted_ids = items.ids[items.order]
        for batch in batches:
            for part in _chunks(batch, CHUNK_USERS):
                # users with most targets first: those with more than j are a prefix
                part = part.take(pa.array(np.argsort(-part.column("targets").value_lengths().to_numpy(zero_copy_only=False), kind="stable")))
                uid, m, u = part.column("id").to_numpy(zero_copy_only=False), part.num_rows, _matrix(part.column("features"))
                size = part.column("targets").value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(m), size)
                item = part.column("targets").flatten().to_numpy(zero_copy_only=False)
                seen = _Seen(part.column("seen"), items)
                if known:
                    own = part.column("keys").flatten().to_numpy(zero_copy_only=False)
                else:
                    own, at = np.full(len(row), np.inf), items.find(item)
                    free = np.flatnonzero((at >= 0) & ~np.isin(row * len(items.ids) + at, seen.rows * len(items.ids) + seen.at))
                    for s in range(0, len(free), PAIRS):
                        f = free[s : s + PAIRS]
                        own[f] = _pair_keys(metric, u[row[f]], items.mat[at[f]], digits)
                n_free = len(items.ids) - np.bincount(seen.rows, minlength=m)
                below = np.searchsorted(sorted_ids, item) - seen.smaller(row, item)
                above = _above(metric, digits, u, items, seen, size, item, own) if len(items.ids) and len(row) else np.zeros(len(row), np.int64)
                above = np.where(np.isinf(own), n_free[row], above)
                yield pa.record_batch(
                    {
                        USER: pa.array(uid[row].astype(np.int32)),
                        ITEM: pa.array(item.astype(np.int32)),
                        "key": pa.array(own, pa.float64()),
                        "above": pa.array(above),
                        "below": pa.array(below),
                        "n_scored": pa.array(n_free[row]),
                    }
                )

    return run


def _above(metric: str, digits: int | None, u: np.ndarray, items: Items, seen: _Seen, size: np.ndarray, item: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each target (users' targets one after the other, ``size`` each, in falling order of size) the unseen
    items before it. Rough keys settle all items but those near a target's key."""
    m, first = len(u), np.cumsum(size) - size
    above = np.zeros(len(item), np.int64)
    rough = _Rough(metric, u, items, digits)
    usable = rough.usable and bool((rough.length * items.single(metric)[1] < 1e15).all())
    heavy = int(np.searchsorted(-size, -MANY_TARGETS)) if usable else m  # rows before have more targets
    slots, light = int(size[heavy:].max(initial=0)), np.arange(heavy, m)
    wanted = [int(np.searchsorted(-size[heavy:], -j)) for j in range(slots)]  # users with more than j targets end here
    at = [first[heavy : heavy + k] + j for j, k in enumerate(wanted)]
    low, high = np.full((slots, len(light)), np.inf), np.full((slots, len(light)), -np.inf)  # no pair is between
    for j, k in enumerate(wanted):
        low[j, :k], high[j, :k] = rough.below(own[at[j]], light[:k]), rough.at_most(own[at[j]], light[:k])
    most = int(np.diff(items.starts).max(initial=0))
    codes, masks, scale = np.empty(len(light) * most, np.int16), np.empty((3, len(light) * (most + 8)), bool), None
    for b, (s, e) in enumerate(zip(items.starts[:-1], items.starts[1:])):
        ids, mat, width = items.ids[s:e], items.mat[s:e], -(-(e - s) // 8) * 8
        if usable:
            now = rough.scale(b)
            if scale is None or not np.array_equal(now, scale):
                scale = now
                lows, highs = low * scale[heavy:], high * scale[heavy:]
                lo = np.clip(np.trunc(lows), -SEEN_CODE - 1, SEEN_CODE).astype(np.int16)
                hi = np.clip(np.trunc(highs), -SEEN_CODE - 1, SEEN_CODE - 1).astype(np.int16)
            near = rough.block(b, slice(None), scale)
        else:
            near = np.zeros((m, e - s), np.float32)
        seen.mask(near, b, s, value=SEEN_CODE)
        for i in range(heavy):  # its items sorted, and all its targets looked up
            t = slice(first[i], first[i] + size[i])
            unseen_ = np.flatnonzero(near[i] != SEEN_CODE)
            key = _pair_keys(metric, np.broadcast_to(u[i], (len(unseen_), u.shape[1])), mat[unseen_], digits)
            values, place = np.unique(key, return_inverse=True)
            both = np.sort(place * (e - s + 1) + unseen_)
            at_value = np.searchsorted(values, own[t])
            tie = np.append(values, np.nan)[at_value] == own[t]
            above[t] += np.searchsorted(both, at_value * (e - s + 1) + np.where(tie, np.searchsorted(ids, item[t]), 0))
        if not slots:
            continue
        # cut to whole numbers, rough keys keep their order: a smaller code is a smaller key, an equal one says nothing
        code = codes[: len(light) * (e - s)].reshape(len(light), e - s)
        np.copyto(code, near[heavy:], casting="unsafe")
        sure, may, unsure = (x[: len(light) * width].reshape(len(light), width) for x in masks)
        sure[:, e - s :] = may[:, e - s :] = False
        unsure[:] = False
        for j, k in enumerate(wanted):
            np.less(code[:k], lo[j, :k, None], out=sure[:k, : e - s])
            np.less_equal(code[:k], hi[j, :k, None], out=may[:k, : e - s])
            above[at[j]] += _row_counts(sure[:k])
            np.not_equal(sure[:k], may[:k], out=may[:k])
            np.logical_or(unsure[:k], may[:k], out=unsure[:k])
        rows, cols = _where(unsure)
        for p in range(0, len(rows), PAIRS // slots):
            r, c = rows[p : p + PAIRS // slots], cols[p : p + PAIRS // slots]
            value, mine = near[r + heavy, c], code[r, c]
            same = (mine >= lo[:, r]) & (mine <= hi[:, r]) & (np.arange(slots)[:, None] < size[r + heavy])
            j, n = np.nonzero(same & (value < lows[:, r]))
            above += np.bincount(first[r[n] + heavy] + j, minlength=len(above))
            j, n = np.nonzero(same & (value >= lows[:, r]) & (value <= highs[:, r]))
            t, rr, cc = first[r[n] + heavy] + j, r[n] + heavy, c[n]
            for q in range(0, len(t), PAIRS):
                tt, cq = t[q : q + PAIRS], cc[q : q + PAIRS]
                key = _pair_keys(metric, u[rr[q : q + PAIRS]], mat[cq], digits)
                before = (key < own[tt]) | ((key == own[tt]) & (ids[cq] < item[tt]))
                above += np.bincount(tt[before], minlength=len(above))
    return above


def _row_counts(mask: np.ndarray) -> np.ndarray:
    """True cells of each row; rows are of whole 8-byte words."""
    words, total = mask.view(np.uint64), 0
    for s in range(0, words.shape[1], 255):  # a byte adds up 255 words at most
        total = total + words[:, s : s + 255].sum(axis=1).view(np.uint8).reshape(-1, 8).sum(axis=1, dtype=np.int64)
    return total


def _target_keys(metric: str, digits: int | None):
    def run(batches):
        for batch in batches:
            u, v = _matrix(batch.column("features")), _matrix(batch.column("_v"))
            yield pa.record_batch({"id": batch.column("id"), "_i": batch.column("_i"), "key": pa.array(_pair_keys(metric, u, v, digits), pa.float64())})

    return run


def rank_targets(
    users: DataFrame, items: DataFrame, targets: DataFrame, seen: DataFrame, metric: str = "dot", digits: int | None = None,
    block_items: int = BLOCK_ITEMS, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """For every (user, item) of ``targets`` (one row per pair): ``is_scored``, ``above`` (unseen items before it in
    the user's order), ``below`` (unseen items with a smaller id) and ``n_scored`` (the user's unseen
    items). A pair that was seen, or without vectors, is not scored. Of a user's targets and counts only
    users x targets rows are ever shuffled."""
    segments = _Segments.of(items, metric, block_items, max_broadcast_bytes)
    u, n_users = _users(users, segments)
    pairs = targets.select(F.col(USER).cast("long").alias("id"), F.col(ITEM).cast("long").alias("_i"))
    keyed = pairs
    if segments.n > 1:  # a target's own segment gives its key; the others count against it
        vec = segments.items.select(F.col("id").alias("_i"), F.col("features").alias("_v"))
        known = pairs.join(unseen(targets, seen).select(F.col(USER).cast("long").alias("id"), F.col(ITEM).cast("long").alias("_i")), ["id", "_i"], "left_semi")
        found = known.join(vec, "_i").join(u, "id").mapInArrow(_target_keys(metric, digits), "id long, _i long, key double")
        keyed = materialize(pairs.join(found, ["id", "_i"], "left").withColumn("key", F.coalesce("key", F.lit(float("inf")))), "targets")
    each = F.array_sort(F.collect_list(F.struct("_i", *(["key"] if segments.n > 1 else []))))
    per = keyed.groupBy("id").agg(each.alias("t")).select("id", F.col("t._i").alias("targets"), *([F.col("t.key").alias("keys")] if segments.n > 1 else []))
    out = None
    for s in range(segments.n):
        rows = _spread(segments.with_seen(u.join(per, "id"), seen, s), n_users, segments.n_items // segments.n)
        part = rows.mapInArrow(_counts(metric, digits, segments.load(s), segments.n > 1), f"{USER} int, {ITEM} int, key double, above long, below long, n_scored long")
        out = part if out is None else out.unionByName(part)
    if segments.n > 1:
        out = out.groupBy(USER, ITEM).agg(F.first("key").alias("key"), *[F.sum(c).alias(c) for c in ("above", "below", "n_scored")])
    counts = out.select(USER, ITEM, (F.col("key") < float("inf")).alias("is_scored"), "above", "below", "n_scored")
    full = targets.select(F.col(USER).cast("int").alias(USER), F.col(ITEM).cast("int").alias(ITEM)).join(counts, [USER, ITEM], "left")
    return full.na.fill(0, ["above", "below", "n_scored"]).na.fill(False, ["is_scored"])


def knn_budget(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, budget: int, digits: int | None = None
) -> DataFrame:
    """Nearest-item recommendation with a fixed neighbour budget: the ``budget`` nearest items
    by Euclidean distance, minus seen ones, first k kept (fewer if seen items used the budget)."""
    cand = score_users(users, items, "euclidean", top_n=budget, digits=digits)
    return top_k(unseen(cand, seen), USER, [F.col(SCORE).asc(), F.col(ITEM)], k)


def knn_lsh(
    users: DataFrame,
    items: DataFrame,
    seen: DataFrame,
    k: int,
    max_distance: float | None = None,
    bucket_length: float = 1.0,
    num_tables: int = 3,
    seed: int = 0,
) -> DataFrame:
    """Approximate nearest unseen items with bucketed random projection LSH: candidate pairs
    share a bucket in at least one hash table (and lie within ``max_distance``, if given); seen items
    are removed and the first k kept.

    A user whose buckets hold fewer than k unseen items gets the exact nearest items instead, so
    every list has min(k, unseen) items. That depends on the user's buckets alone, never on the size
    of the input. Only ids meet in the bucket join (a skewed bucket is split by AQE); the vectors
    are joined to the distinct pairs.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    lsh = BucketedRandomProjectionLSH(
        inputCol="v", outputCol="h", bucketLength=bucket_length, numHashTables=num_tables, seed=seed
    ).fit(items.select(array_to_vector("features").alias("v")))

    def buckets(df: DataFrame, id_col: str) -> DataFrame:
        hashed = lsh.transform(df.select(F.col("id").alias(id_col), array_to_vector("features").alias("v")))
        return hashed.select(id_col, F.posexplode("h").alias("tbl", "hv")).select(id_col, "tbl", vector_to_array("hv")[0].alias("bkt"))

    pairs = unseen(buckets(users, USER).join(buckets(items, ITEM), ["tbl", "bkt"]).select(USER, ITEM).distinct(), seen)
    uf = users.select(F.col("id").alias(USER), F.col("features").alias("_uf"))
    itf = items.select(F.col("id").alias(ITEM), F.col("features").alias("_if"))
    near = pairs.join(uf, USER).join(itf, ITEM).select(USER, ITEM, F.sqrt(sq_dist("_uf", "_if")).alias(SCORE))
    if max_distance is not None:
        near = near.filter(F.col(SCORE) <= max_distance)
    approx = cut_lineage(top_k(near, USER, [F.col(SCORE).asc(), F.col(ITEM)], k))
    full = approx.groupBy(USER).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k).select(F.col(USER).alias("id"))
    exact = topk_unseen(users.join(full, "id", "left_anti"), items, seen, k, "euclidean")
    kept = approx.join(full.withColumnRenamed("id", USER), USER, "left_semi")
    return kept.unionByName(exact.select(*approx.columns))
