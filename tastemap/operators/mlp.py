"""Feed-forward regressor (relu hidden layers, linear output, MSE loss, Adam) trained as a Spark job.

Spark ML has no neural regressor, so training is data-parallel local SGD: rows are hashed into
fixed partitions once and packed as matrices (checkpointed); one partition trains all its epochs
in one task, several average after each: then an epoch is one job in which every partition starts
from the current weights and Adam state, runs mini-batch Adam over its rows with numpy, and
emits its weights scaled by its row count in chunks of ``CHUNK`` values. The chunks are
summed by a Spark aggregate, so the driver receives one model's worth of numbers per epoch
whatever the number of partitions. These tasks hold rows and compute in single precision (as the
published networks do); one task, full batches, gradients and prediction stay in double precision.
Prediction broadcasts the weights into ``mapInArrow``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemap.operators.prep import holdout_flag
from tastemap.schema import ITEM, RATING, SCORE, USER
from tastemap.session import cut_lineage

CHUNK = 4096
EPS = 1e-7
BETA1, BETA2 = 0.9, 0.999


def layer_sizes(n_in: int, hidden: tuple[int, ...]) -> list[int]:
    return [n_in, *hidden, 1]


def init_theta(sizes: list[int], seed: int) -> np.ndarray:
    """Glorot-uniform weights, zero biases, flattened layer by layer (W then b)."""
    rng = np.random.RandomState(seed)
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        lim = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-lim, lim, size=a * b), np.zeros(b)]
    return np.concatenate(parts)


def unpack(theta: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, o = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        w = theta[o : o + a * b].reshape(a, b)
        o += a * b
        out.append((w, theta[o : o + b]))
        o += b
    return out


def forward(x: np.ndarray, layers) -> np.ndarray:
    h = x
    for i, (w, b) in enumerate(layers):
        h = h @ w + b
        if i < len(layers) - 1:
            h = np.maximum(h, 0.0)
    return h[:, 0]


def loss_and_grad(x: np.ndarray, y: np.ndarray, theta: np.ndarray, sizes: list[int]):
    layers = unpack(theta, sizes)
    acts, h = [x], x
    for i, (w, b) in enumerate(layers):
        h = h @ w + b
        if i < len(layers) - 1:
            h = np.maximum(h, 0.0)
        acts.append(h)
    pred = h[:, 0]
    err = pred - y
    n = len(y)
    grads = []
    delta = (2.0 / n) * err[:, None]
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        grads.append((acts[i].T @ delta, delta.sum(axis=0)))
        if i > 0:
            delta = (delta @ w.T) * (acts[i] > 0)
    flat = np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in reversed(grads)])
    return err, flat


def _matrix(batch, col: str, dim: int) -> np.ndarray:
    """Rows of a fixed-length list column as an (n, dim) float64 matrix, without per-row objects."""
    arr = batch.column(col)
    if arr.null_count:
        arr = pa.array(arr.to_pylist(), type=arr.type)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(arr), dim)


def _gather(batch, feat_col: str, dim: int, item_block) -> np.ndarray:
    """Feature matrix of a batch: the row's own features, followed by its item's broadcast
    features when an item-side block is given."""
    if item_block is None:
        return _matrix(batch, feat_col, dim)
    ids, mat = item_block.value
    own = _matrix(batch, feat_col, dim - mat.shape[1])
    pos = np.searchsorted(ids, batch.column(ITEM).to_numpy(zero_copy_only=False).astype(np.int64))
    return np.hstack([own, mat[pos]])


PACKED_SCHEMA = "x binary, y binary, val binary, item binary"
PACK_ROWS = 16_384


def _pack(feat_col: str, label_col: str, item_block, dtype=np.float64):
    """Task function: training rows as matrices in binary cells, so that an epoch reads bytes instead of
    converting rows; items of a broadcast catalogue as their positions in it. A cell's validation rows come last."""

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(s, PACK_ROWS)
                items = part.column(ITEM).to_numpy(zero_copy_only=False).astype(np.int64)
                if item_block is not None:
                    items = np.searchsorted(item_block.value[0], items)
                x = _matrix(part, feat_col, len(part.column(feat_col)[0]))
                y = part.column(label_col).to_numpy(zero_copy_only=False).astype(np.float64)
                val = part.column("_val").to_numpy(zero_copy_only=False).astype(bool)
                by = np.argsort(val, kind="stable")
                cells = {"x": x[by].astype(dtype, copy=False).tobytes(), "y": y[by].astype(dtype, copy=False).tobytes(), "val": val[by].tobytes(), "item": items[by].tobytes()}
                yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.binary()) for k, v in cells.items()})

    return run


class _Rows:
    """Rows of a packed cell: their own features and, of a broadcast catalogue, their items', put together when they
    are asked for."""

    def __init__(self, own: np.ndarray, mat: np.ndarray | None = None, items: np.ndarray | None = None):
        self.own, self.mat, self.items = own, mat, items
        self.dim = own.shape[1] + (0 if mat is None else mat.shape[1])

    def into(self, out: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        """Features of ``rows`` as the first columns of ``out``."""
        k = self.own.shape[1]
        out[:, :k] = self.own[rows]
        if self.mat is not None:
            out[:, k : self.dim] = self.mat[self.items[rows]]
        return out


def _cells(batch, item_block, dtype=np.float64):
    """(rows, y, is_val) of every packed cell of a batch."""
    mat = None if item_block is None else item_block.value[1].astype(dtype, copy=False)
    for i in range(batch.num_rows):
        y = np.frombuffer(batch.column("y")[i].as_buffer(), dtype)
        x = np.frombuffer(batch.column("x")[i].as_buffer(), dtype).reshape(len(y), -1)
        items = None if mat is None else np.frombuffer(batch.column("item")[i].as_buffer(), np.int64)
        yield _Rows(x, mat, items), y, np.frombuffer(batch.column("val")[i].as_buffer(), bool)


def _unpack_rows(batch, item_block, dtype=np.float64):
    """(x, y, is_val) of every packed cell of a batch; item-side features are appended."""
    for rows, y, is_val in _cells(batch, item_block, dtype):
        yield rows.own if rows.mat is None else rows.into(np.empty((len(y), rows.dim), dtype), slice(None)), y, is_val


BATCHES_AHEAD = 16  # mini-batches whose rows are gathered at once


class _Net:
    """:func:`loss_and_grad` of one mini-batch after the other, into arrays that are kept. A layer's weights and
    biases lie one after the other in ``theta``, so they are one matrix here, whose last row meets a column of ones."""

    def __init__(self, theta: np.ndarray, sizes: list[int], most: int):
        kind = theta.dtype
        self.flat = np.empty_like(theta)
        self.bits = np.dtype(f"i{kind.itemsize}")
        self.w, self.grad, self.acts, self.delta, self.alive, o = [], [], [], [], [], 0
        for a, b in zip(sizes[:-1], sizes[1:]):
            e = o + (a + 1) * b
            self.w.append(theta[o:e].reshape(a + 1, b))
            self.grad.append(self.flat[o:e].reshape(a + 1, b))
            self.acts.append(np.ones((most, -(-(b + 1) // 16) * 16), kind))
            self.delta.append(np.empty((most, b), kind))
            self.alive.append(np.empty((most, b), self.bits))
            o = e

    def gradient(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The gradient at rows ``x``, which end with a one; ``y`` becomes their errors."""
        n, last, inputs = len(y), len(self.w) - 1, [x]
        for i, w in enumerate(self.w):
            b = w.shape[1]
            h = self.acts[i][:n]
            np.matmul(inputs[-1], w, out=h[:, :b])
            if i < last:
                np.maximum(h[:, :b], 0.0, out=h[:, :b])
                inputs.append(h[:, : b + 1])
        np.subtract(h[:, 0], y, out=y)
        delta = np.multiply(y[:, None], 2.0 / n, out=self.delta[last][:n])
        for i in range(last, -1, -1):
            np.matmul(inputs[i].T, delta, out=self.grad[i])
            if i:
                into, alive = self.delta[i - 1][:n], self.alive[i - 1][:n]
                np.matmul(delta, self.w[i][:-1].T, out=into)
                # all bits where the unit was above 0, none elsewhere
                np.negative(inputs[i][:, :-1].view(self.bits), out=alive)
                np.right_shift(alive, self.bits.itemsize * 8 - 1, out=alive)
                bits = into.view(self.bits)
                np.bitwise_and(bits, alive, out=bits)
                delta = into
        return self.flat


@dataclass
class _Adam:
    """Weights and moments, updated batch by batch."""

    theta: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: int
    sizes: list[int]
    lr: float

    def pass_over(self, x: np.ndarray | _Rows, y: np.ndarray, order: np.ndarray, batch_size: int) -> tuple[float, float]:
        """Mini-batches in the given order; the sums of squared and absolute errors as they were met."""
        sse = sae = 0.0
        x = x if isinstance(x, _Rows) else _Rows(x)
        net = _Net(self.theta, self.sizes, min(batch_size, len(order)))
        for a in range(0, len(order), batch_size * BATCHES_AHEAD):
            idx = order[a : a + batch_size * BATCHES_AHEAD]
            rows, err = x.into(np.ones((len(idx), x.dim + 1), self.theta.dtype), idx), y[idx]
            for s in range(0, len(idx), batch_size):
                self.step(net.gradient(rows[s : s + batch_size], err[s : s + batch_size]))
            sse += float(np.square(err, dtype=np.float64).sum())
            sae += float(np.abs(err).sum(dtype=np.float64))
        return sse, sae

    def step(self, g: np.ndarray) -> None:
        self.t += 1
        rate = self.lr * np.sqrt(1 - BETA2**self.t) / (1 - BETA1**self.t)
        self.m *= BETA1
        self.m += (1 - BETA1) * g
        self.v *= BETA2
        g *= g
        g *= 1 - BETA2
        self.v += g
        np.sqrt(self.v, out=g)
        g += EPS
        np.divide(self.m, g, out=g)
        g *= float(rate)
        self.theta -= g


def _errors(x: np.ndarray, y: np.ndarray, layers) -> tuple[float, float]:
    err = forward(x, layers) - y
    return float(np.square(err, dtype=np.float64).sum()), float(np.abs(err).sum(dtype=np.float64))


def _epoch_fn(state, sizes, batch_size, lr, seed, epoch, train: bool = True, item_block=None):
    """One pass over a partition. Validation rows are scored with the incoming weights (the
    averaged result of the previous epoch); training rows run mini-batch Adam, shuffled within
    each packed cell (rows are already hashed across partitions). Memory is bounded by the
    cell size, not the partition."""

    def run(batches):
        from pyspark import TaskContext

        theta, m, v = (a.astype(np.float32) for a in state.value[:3])
        t0 = state.value[3]
        part = TaskContext.get().partitionId()
        adam = _Adam(theta.copy(), m, v, t0, sizes, lr)
        layers_in = unpack(theta, sizes)
        rng = np.random.RandomState([seed, epoch, part])
        n, sse, sae, vn, vsse, vsae = 0, 0.0, 0.0, 0, 0.0, 0.0
        for batch in batches:
            for x, y, is_val in _cells(batch, item_block, np.float32):
                held = int(is_val.sum())
                k = len(y) - held  # validation rows are the last
                if held:
                    a, b = _errors(x.into(np.empty((held, x.dim), np.float32), slice(k, None)), y[k:], layers_in)
                    vn, vsse, vsae = vn + held, vsse + a, vsae + b
                if not train or not k:
                    continue
                a, b = adam.pass_over(x, y, rng.permutation(k), batch_size)
                n, sse, sae = n + k, sse + a, sae + b
        chunks = list(range(0, len(theta), CHUNK))
        w = lambda a: [a[s : s + CHUNK].astype(np.float64) * n for s in chunks]
        k = len(chunks)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part] * k, pa.int32()),
                "chunk": pa.array(range(k), pa.int32()),
                "w": pa.array(w(adam.theta), pa.list_(pa.float64())),
                "m": pa.array(w(adam.m), pa.list_(pa.float64())),
                "v": pa.array(w(adam.v), pa.list_(pa.float64())),
                "n": pa.array([n] * k, pa.int64()),
                "sse": pa.array([sse] * k, pa.float64()),
                "sae": pa.array([sae] * k, pa.float64()),
                "steps": pa.array([(adam.t - t0) * n] * k, pa.int64()),
                "vn": pa.array([vn] * k, pa.int64()),
                "vsse": pa.array([vsse] * k, pa.float64()),
                "vsae": pa.array([vsae] * k, pa.float64()),
            }
        )

    return run


def _full_batch_fn(state, sizes, item_block=None):
    """Task function: a partition's share of the full batch's gradient (a sum over its rows) and of the errors,
    at the incoming weights. It holds one packed cell at a time."""

    def run(batches):
        theta = state.value
        total, layers = np.zeros(len(theta)), unpack(theta, sizes)
        n, sse, sae, vn, vsse, vsae = 0, 0.0, 0.0, 0, 0.0, 0.0
        for batch in batches:
            for x, y, is_val in _unpack_rows(batch, item_block):
                if is_val.any():
                    a, b = _errors(x[is_val], y[is_val], layers)
                    vn, vsse, vsae = vn + int(is_val.sum()), vsse + a, vsae + b
                    x, y = x[~is_val], y[~is_val]
                if len(y):
                    err, g = loss_and_grad(x, y, theta, sizes)
                    total += g * len(y)
                    n, sse, sae = n + len(y), sse + float((err * err).sum()), sae + float(np.abs(err).sum())
        yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(len(total) + 6)), "x": pa.array(np.concatenate([total, [n, sse, sae, vn, vsse, vsae]]))})

    return run


def _fit_full_batch(data: DataFrame, adam: _Adam, epochs: int, item_block) -> list[tuple]:
    """One step an epoch on the gradient of all rows, which the tasks share; returns the history."""
    history = []
    for epoch in range(epochs + 1):
        state = data.sparkSession.sparkContext.broadcast(adam.theta.copy())
        sums = data.mapInArrow(_full_batch_fn(state, adam.sizes, item_block), "pos long, x double").groupBy("pos").agg(F.sum("x").alias("x"))
        tot = sums.toArrow().sort_by("pos").column("x").to_numpy().copy()
        state.unpersist()
        n, sse, sae, vn, vsse, vsae = tot[-6:].tolist()
        if epoch and vn:
            history[-1][3:] = [vsse / vn, vsae / vn]
        if epoch < epochs:
            adam.step(tot[:-6] / max(1, n))
            history.append([epoch + 1, sse / max(1, n), sae / max(1, n), None, None])
    return [tuple(r) for r in history]


def _train_fn(theta, sizes, batch_size, lr, seed, epochs, item_block=None):
    """All epochs over the one partition of a small training set, as one task: nothing is averaged, so no
    job is needed between epochs. Its rows fit the task, as they are at most
    ``WORK_PER_PARTITION`` / ``ROW_WORK``."""

    def run(batches):
        cells = [c for batch in batches for c in _unpack_rows(batch, item_block)]
        if not cells:
            return
        x, y, is_val = (np.concatenate([c[i] for c in cells]) for i in range(3))
        xv, yv, x, y = x[is_val], y[is_val], x[~is_val], y[~is_val]
        adam = _Adam(theta.copy(), np.zeros_like(theta), np.zeros_like(theta), 0, sizes, lr)
        history = []
        for epoch in range(epochs):
            sse, sae = adam.pass_over(x, y, np.random.RandomState([seed, epoch, 0]).permutation(len(y)), batch_size)
            val = _errors(xv, yv, unpack(adam.theta, sizes)) if len(yv) else (np.nan, np.nan)
            history.append([sse / max(1, len(y)), sae / max(1, len(y)), val[0] / max(1, len(yv)), val[1] / max(1, len(yv))])
        yield pa.RecordBatch.from_pydict(
            {"theta": pa.array([adam.theta], pa.list_(pa.float64())), "history": pa.array([history], pa.list_(pa.list_(pa.float64())))}
        )

    return run


EPOCH_SCHEMA = (
    "part int, chunk int, w array<double>, m array<double>, v array<double>, n long, sse double, sae double, steps long, "
    "vn long, vsse double, vsae double"
)


HISTORY_SCHEMA = "epoch int, loss double, mae double, val_loss double, val_mae double"
SCALARS = ("n", "sse", "sae", "steps", "vn", "vsse", "vsae")
SUM_FAN_IN = 16  # partial models that one task, or the driver, adds up


def _sum_partials(parts: DataFrame, n_part: int, size: int) -> dict:
    """Sum the partial models of all partitions in a fixed order: groups of ``SUM_FAN_IN`` partitions
    in partition order, then groups of groups. Only the last at most ``SUM_FAN_IN`` sums reach the
    driver, so its memory is bounded by the model whatever the number of partitions."""
    while n_part > SUM_FAN_IN:
        up = F.floor(F.col("part") / SUM_FAN_IN).cast("int").alias("up")
        parts = parts.select(up, "*").groupBy("chunk", "up").applyInArrow(_sum_group, EPOCH_SCHEMA)
        n_part = -(-n_part // SUM_FAN_IN)
    return _sum_direct(parts.toArrow().sort_by([("part", "ascending"), ("chunk", "ascending")]), size)


def _sum_direct(table: pa.Table, size: int) -> dict:
    """Add up rows of (part, chunk, sums) in their order."""
    chunk = table.column("chunk").to_numpy()
    out = {}
    for name in ("w", "m", "v"):
        acc = np.zeros(size)
        for c, a in zip(chunk, table.column(name).to_numpy(zero_copy_only=False)):
            acc[c * CHUNK : c * CHUNK + len(a)] += a
        out[name] = acc
    first = chunk == 0
    for name in SCALARS:
        out[name] = table.column(name).to_numpy()[first].sum().item()
    return out


def _sum_group(key, table):
    """One chunk of at most ``SUM_FAN_IN`` partial models, added up in their order."""
    table = table.sort_by("part")
    out = {"part": [key[1].as_py()], "chunk": [key[0].as_py()]}
    for name in ("w", "m", "v"):
        rows = table.column(name).combine_chunks()
        flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        out[name] = [np.add.accumulate(flat, axis=0)[-1]]
    for name in SCALARS:
        out[name] = [sum(table.column(name).to_pylist())]
    kinds = {"part": pa.int32(), "chunk": pa.int32(), **dict.fromkeys(("w", "m", "v"), pa.list_(pa.float64()))}
    kinds |= {c: pa.float64() if c in ("sse", "sae", "vsse", "vsae") else pa.int64() for c in SCALARS}
    names = ["part", "chunk", "w", "m", "v", *SCALARS]
    return pa.table({c: pa.array(out[c], kinds[c]) for c in names})


@dataclass
class MLPModel:
    theta: np.ndarray
    sizes: list[int]
    features: str = "features"
    item_ids: np.ndarray | None = None  # sorted ids of the broadcast item-side features
    item_mat: np.ndarray | None = None
    item_side: DataFrame | None = None  # item-side features joined per row (large catalogues)

    def _rows(self, rows: DataFrame) -> DataFrame:
        if self.item_ids is not None:
            known = self.item_side.select(F.col("id").alias(ITEM))
            return rows.join(known, ITEM, "left_semi")
        if self.item_side is not None:
            return _join_item_side(rows, self.item_side, self.features)
        return rows

    def predict(self, rows: DataFrame, out_col: str = SCORE) -> DataFrame:
        """Adds ``out_col`` = network output for each row's features (rows whose item has no
        item-side features are dropped)."""
        rows = self._rows(rows)
        spark = rows.sparkSession
        bc = spark.sparkContext.broadcast((self.theta, self.sizes))
        block = spark.sparkContext.broadcast((self.item_ids, self.item_mat)) if self.item_ids is not None else None
        feat = self.features
        schema = T.StructType(list(rows.schema.fields) + [T.StructField(out_col, T.DoubleType())])

        def run(batches):
            theta, sizes = bc.value
            layers = unpack(theta, sizes)
            for batch in batches:
                if batch.num_rows:
                    out = forward(_gather(batch, feat, sizes[0], block), layers)
                else:
                    out = np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    list(batch.columns) + [pa.array(out, pa.float64())], schema=batch.schema.append(pa.field(out_col, pa.float64()))
                )

        return rows.mapInArrow(run, schema)

    def evaluate(self, rows: DataFrame, label: str = RATING) -> DataFrame:
        """One row: mse, mae, n over the given labelled rows."""
        cols = [self.features, label] + ([ITEM] if self.item_side is not None else [])
        p = self.predict(rows.select(*cols), "_p")
        err = F.col("_p") - F.col(label)
        return p.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"), F.count(F.lit(1)).alias("n"))


def _as_double(c):
    return F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("double"))


def _join_item_side(rows: DataFrame, item_side: DataFrame, features: str) -> DataFrame:
    itf = item_side.select(F.col("id").alias(ITEM), _as_double("features").alias("_itf"))
    return rows.join(itf, ITEM).withColumn(features, F.concat(_as_double(features), F.col("_itf"))).drop("_itf")


# Item-side tables of at most this many bytes (rows x dimension, counted first) are broadcast; larger ones
# are joined per row. Both give the same feature rows.
MAX_ITEM_SIDE_BYTES = 64 << 20
# A training set of which every epoch is one batch is not fetched into one task above so many bytes.
MAX_TASK_BYTES = 64 << 20
# Training rows x (weights + what a row costs besides, in weights) of one partition: the number of partitions follows
# the data and the network, not the machine. An epoch of a partition takes about 0.2 s, several times what its task and
# the sum of its model take, whatever the network.
WORK_PER_PARTITION = 2_800_000_000
ROW_WORK = 6_000


def partitions_for(n_rows: int, n_weights: int) -> int:
    return max(1, -(-n_rows * (n_weights + ROW_WORK) // WORK_PER_PARTITION))


def gradient(rows: DataFrame, theta: np.ndarray, hidden: tuple[int, ...], label: str = RATING, features: str = "features") -> DataFrame:
    """(pos, grad): the gradient of the mean squared error over all ``rows`` at the weights ``theta`` (in their
    flat order). Tasks add up their rows' shares; Spark adds up the tasks."""
    base = rows.select(features, F.col(label).cast("double").alias("_y"))
    n_rows, n_in = base.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
    sizes = layer_sizes(n_in or 0, hidden)
    theta = np.asarray(theta, np.float64)

    def run(batches):
        total = np.zeros(len(theta))
        for batch in batches:
            for s in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(s, PACK_ROWS)
                y = part.column("_y").to_numpy(zero_copy_only=False)
                total += loss_and_grad(_matrix(part, features, sizes[0]), y, theta, sizes)[1] * (len(y) / n_rows)
        yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(len(theta))), "grad": pa.array(total)})

    return base.mapInArrow(run, "pos long, grad double").groupBy("pos").agg(F.sum("grad").alias("grad"))


def fit_mlp(
    rows: DataFrame,
    label: str = RATING,
    features: str = "features",
    hidden: tuple[int, ...] = (20, 8),
    epochs: int = 32,
    batch_size: int = 256,
    lr: float = 1e-3,
    seed: int = 0,
    validation_frac: float = 0.1,
    num_partitions: int | None = None,
    item_side: DataFrame | None = None,
    max_item_side_bytes: int = MAX_ITEM_SIDE_BYTES,
    theta: np.ndarray | None = None,
) -> tuple[MLPModel, DataFrame]:
    """Train on ``rows`` (features array, label), from the weights ``theta`` if given. A hash hold-out of ``validation_frac`` of the
    (user, item) pairs is scored after each epoch. Returns the model and its per-epoch history
    (epoch, loss, mae, val_loss, val_mae).

    ``item_side`` (``id, features``) appends per-item features (item factors, tags) to each
    row's own features. A catalogue of at most ``max_item_side_bytes`` is broadcast as one
    sorted matrix and gathered inside the tasks, so wide item features are not stored per
    training row; a larger one is joined per row.
    """
    spark = rows.sparkSession
    item_ids = item_mat = None
    if item_side is not None:
        item_side = cut_lineage(item_side)  # counted, fetched and joined
        n_items, dim = item_side.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
        if n_items * (dim or 0) * 8 <= max_item_side_bytes:
            pdf = item_side.select("id", "features").orderBy("id").toPandas()
            item_ids = pdf["id"].to_numpy().astype(np.int64)
            item_mat = np.stack(pdf["features"].to_numpy()).astype(np.float64)
            rows = rows.join(item_side.select(F.col("id").alias(ITEM)), ITEM, "left_semi")
        else:
            rows = _join_item_side(rows, item_side, features)
    base = rows.select(USER, ITEM, features, F.col(label).cast("double").alias("_y"))
    flag = holdout_flag(base, validation_frac, seed) if validation_frac > 0 else F.lit(False)
    # fixed partitions, and within them a seeded pseudo-random order that does not depend on
    # the upstream plan: training is reproducible and batches mix users
    n_rows, n_in = base.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
    sizes = layer_sizes((n_in or 0) + (item_mat.shape[1] if item_mat is not None else 0), hidden)
    theta = init_theta(sizes, seed) if theta is None else np.asarray(theta, np.float64)
    # epochs stream packed cells, so partition size does not bound memory
    n_part = num_partitions or partitions_for(n_rows, len(theta))
    block = spark.sparkContext.broadcast((item_ids, item_mat)) if item_ids is not None else None
    full = n_part == 1 and batch_size >= n_rows and n_rows * (n_in or 0) * 8 > MAX_TASK_BYTES
    dtype = np.float64 if n_part == 1 else np.float32
    flagged = base.withColumn("_val", flag)
    if n_part > 1:
        flagged = flagged.withColumn(features, F.transform(features, lambda x: x.cast("float")))
    if not full:
        flagged = flagged.repartition(n_part, USER, ITEM).sortWithinPartitions(F.xxhash64(USER, ITEM, F.lit(seed)))
    data = cut_lineage(flagged.select(features, "_y", "_val", ITEM).mapInArrow(_pack(features, "_y", block, dtype), PACKED_SCHEMA))
    model = lambda weights: MLPModel(weights, sizes, features, item_ids, item_mat, item_side)
    if full:
        adam = _Adam(theta.copy(), np.zeros_like(theta), np.zeros_like(theta), 0, sizes, lr)
        rows_ = _fit_full_batch(data, adam, epochs, block)
        return model(adam.theta), spark.createDataFrame(rows_, HISTORY_SCHEMA)
    if n_part == 1:
        done = data.mapInArrow(_train_fn(theta, sizes, batch_size, lr, seed, epochs, block), "theta array<double>, history array<array<double>>").first()
        rows_ = [] if done is None else [(i + 1, *(None if v != v else v for v in r)) for i, r in enumerate(done["history"])]
        return model(theta if done is None else np.array(done["theta"])), spark.createDataFrame(rows_, HISTORY_SCHEMA)
    m, v, t = np.zeros_like(theta), np.zeros_like(theta), 0
    history = []
    # job e trains epoch e and scores the validation rows with the weights of epoch e - 1;
    # one more scoring-only pass gives the last epoch's validation loss
    for epoch in range(epochs + 1):
        training = epoch < epochs
        state = spark.sparkContext.broadcast((theta, m, v, t))
        fn = _epoch_fn(state, sizes, batch_size, lr, seed, epoch, train=training, item_block=block)
        parts = data.mapInArrow(fn, EPOCH_SCHEMA)
        tot = _sum_partials(parts, n_part, len(theta))
        state.unpersist()
        if epoch > 0 and tot["vn"]:
            history[-1]["val_loss"], history[-1]["val_mae"] = tot["vsse"] / tot["vn"], tot["vsae"] / tot["vn"]
        if not training:
            break
        n = tot["n"]
        theta, m, v = tot["w"] / n, tot["m"] / n, tot["v"] / n
        t = t + int(round(tot["steps"] / n))
        rec = {"epoch": epoch + 1, "loss": tot["sse"] / n, "mae": tot["sae"] / n, "val_loss": None, "val_mae": None}
        history.append(rec)
    hist = spark.createDataFrame([(r["epoch"], r["loss"], r["mae"], r["val_loss"], r["val_mae"]) for r in history], HISTORY_SCHEMA)
    return model(theta), hist
