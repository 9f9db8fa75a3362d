"""Kernels that decide how long the queries take over large tables, held against their plain forms."""

import numpy as np
import pyarrow as pa
import pytest

from tastemap.operators import mlp, retrieve


def test_partitions_follow_the_cost_of_a_row():
    # an epoch's task was a few dozen batches of a large network, and most of its time went into its start and its model
    assert mlp.partitions_for(280_000, 38_737) <= 5
    assert mlp.partitions_for(28_800_000, 38_737) <= 500
    assert mlp.partitions_for(2_880_000, 997) == 8  # a small network's rows cost more than its weights say
    assert mlp.partitions_for(10, 997) == mlp.partitions_for(0, 997) == 1


@pytest.mark.parametrize("kind, digits", [(np.float64, 1e-12), (np.float32, 1e-4)])
def test_kept_arrays_give_the_gradient_of_every_batch(kind, digits):
    rng = np.random.RandomState(3)
    sizes = mlp.layer_sizes(7, (17, 5))
    theta = mlp.init_theta(sizes, 1).astype(kind)
    net = mlp._Net(theta, sizes, 12)
    for n in (12, 5, 1, 12):  # the arrays are longer than a last batch
        x, y = rng.randn(n, 7).astype(kind), rng.randn(n).astype(kind)
        err, grad = mlp.loss_and_grad(x, y, theta, sizes)
        got = net.gradient(np.hstack([x, np.ones((n, 1), kind)]), y)
        assert np.allclose(got, grad, atol=digits, rtol=digits) and np.allclose(y, err, atol=digits)
        theta -= kind(0.1) * got  # weights change in place


def test_pass_over_equals_plain_adam():
    rng = np.random.RandomState(4)
    sizes = mlp.layer_sizes(3, (6, 4))
    x, y, order = rng.randn(500, 3), rng.randn(500), rng.permutation(500)
    new = lambda: mlp._Adam(mlp.init_theta(sizes, 0), np.zeros(57), np.zeros(57), 0, sizes, 0.01)
    a, b, sse, sae = new(), new(), 0.0, 0.0
    for s in range(0, 500, 8):
        idx = order[s : s + 8]
        err, g = mlp.loss_and_grad(x[idx], y[idx], a.theta, sizes)
        sse, sae = sse + (err * err).sum(), sae + np.abs(err).sum()
        a.step(g)
    assert np.allclose(b.pass_over(x, y, order, 8), (sse, sae)) and np.allclose(a.theta, b.theta) and a.t == b.t
    assert b.pass_over(x, y, order[:0], 8) == (0.0, 0.0)
    assert np.isfinite(new().pass_over(x, y, order, 1 << 40)).all()


@pytest.mark.parametrize("catalogue", [False, True])
def test_cells_hold_training_rows_first(catalogue):
    rng = np.random.RandomState(2)
    x, y, val, item = rng.randn(40, 3), rng.randn(40), rng.rand(40) < 0.3, rng.randint(0, 5, 40) * 10
    block = _Box((np.arange(5) * 10, rng.randn(5, 2))) if catalogue else None
    batch = pa.record_batch({"f": pa.array(list(x), pa.list_(pa.float64())), "y": y, "_val": val, "item_id": item})
    (packed,) = mlp._pack("f", "y", block)([batch])
    ((rows, got_y, got_val),) = mlp._cells(packed, block)
    full = np.hstack([x, block.value[1][item // 10]]) if catalogue else x
    by = np.concatenate([np.flatnonzero(~val), np.flatnonzero(val)])  # in the order they came
    assert (np.diff(got_val.astype(int)) >= 0).all() and (got_y == y[by]).all()
    assert (rows.into(np.empty((40, rows.dim)), slice(None)) == full[by]).all()
    assert all((a == b).all() for a, b in zip(next(mlp._unpack_rows(packed, block)), (full[by], y[by], val[by])))
    idx = rng.permutation(20)
    new = lambda: mlp._Adam(mlp.init_theta([rows.dim, 4, 1], 0), *np.zeros((2, 4 * rows.dim + 9)), 0, [rows.dim, 4, 1], 0.01)
    a, b = new(), new()
    assert a.pass_over(rows, got_y, idx, 8) == b.pass_over(full[by], y[by], idx, 8) and (a.theta == b.theta).all()



class _Box:
    def __init__(self, value):
        self.value = value


def _vectors(kind, rng):
    iv, uv = rng.standard_normal((700, 6)), rng.standard_normal((50, 6))
    if kind == "one long":
        iv[3] *= 1e6
    elif kind == "short and long":
        iv, uv = iv * np.exp(rng.uniform(-60, 20, (700, 1))), uv * np.exp(rng.uniform(-60, 20, (50, 1)))
    elif kind == "repeated":
        iv = iv[rng.integers(0, 5, 700)]
    elif kind == "zero":
        iv[::2], uv[::3] = 0.0, 0.0
    elif kind == "huge":
        iv, uv = iv * 1e9, uv * 1e9
    elif kind == "out of single precision":
        iv = iv * 1e30
    return iv, uv


KINDS = ("plain", "one long", "short and long", "repeated", "zero", "huge", "out of single precision")


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("metric, digits", [("dot", 6), ("dot", None), ("euclidean", 6)])
def test_counts_by_codes_equal_sorting(metric, digits, kind):
    rng = np.random.default_rng(5)
    iv, uv = _vectors(kind, rng)
    ids = rng.permutation(5000)[:700].astype(np.int64)
    seen = [rng.choice(ids, rng.integers(0, 30), replace=False) for _ in uv]
    size = np.where(np.arange(50) == 7, retrieve.MANY_TARGETS + 3, rng.integers(0, 9, 50))
    targets = [np.sort(rng.choice(ids, n, replace=False)) for n in size]
    lists = lambda a, t: pa.array([list(x) for x in a], pa.list_(t))
    batch = pa.record_batch({"id": pa.array(np.arange(50)), "features": lists(uv, pa.float64()), "seen": lists(seen, pa.int64()), "targets": lists(targets, pa.int64())})
    out = pa.Table.from_batches(list(retrieve._counts(metric, digits, _Box(retrieve.Items.of(ids, iv, metric, 64)), False)([batch]))).to_pylist()
    got = {(r["user_id"], r["item_id"]): r for r in out}
    assert len(got) == size.sum()
    for i, u in enumerate(uv):
        free = np.flatnonzero(~np.isin(ids, seen[i]))
        key = retrieve._pair_keys(metric, np.broadcast_to(u, (len(free), 6)), iv[free], digits)
        place = {ids[free[x]]: n for n, x in enumerate(np.lexsort((ids[free], key)))}
        for t in targets[i]:
            r = got[(i, t)]
            assert np.isfinite(r["key"]) == (t in place)
            assert r["above"] == place.get(t, len(free)) and r["n_scored"] == len(free)


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
@pytest.mark.parametrize("kind", ["plain", "one long", "short and long", "zero"])
def test_codes_fit_16_bits_and_change_no_key(metric, kind):
    iv, uv = _vectors(kind, np.random.default_rng(6))
    items = retrieve.Items.of(np.arange(700), iv, metric, 64)
    rough = retrieve._Rough(metric, uv, items, None)
    for b in range(len(items.starts) - 1):
        scale = rough.scale(b)
        plain = rough.block(b, slice(None)).copy()
        scaled = rough.block(b, slice(None), scale)
        assert (np.frexp(scale)[0] == 0.5).all() and np.abs(scaled).max() < retrieve.SEEN_CODE
        assert (np.abs(scaled.astype(np.float64) / scale[:, None] - plain) <= 0.01 * rough.err[:, None]).all()


def test_tasks_are_many_enough_for_an_even_load():
    # 90,000 users x 120,000 items were 11 tasks: of 8 cores, most waited for the last three
    assert retrieve._tasks(90_000 * 120_000) >= 40
    assert retrieve._tasks(900_000 * 1_200_000) < 2_000 and retrieve._tasks(10**14) < 100_000
    assert retrieve._tasks(10) == 1 and retrieve._tasks(0) == 0
