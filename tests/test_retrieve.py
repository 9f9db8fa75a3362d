import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, interactions
from tastemap.operators import bias, prep, retrieve
from tastemap.sources import fixtures as fx


def _vecs(spark, mat, start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in row]) for i, row in enumerate(mat)], "id int, features array<double>")


def _brute(u, v, metric):
    if metric == "dot":
        return u @ v.T
    return np.sqrt(((u[:, None, :] - v[None, :, :]) ** 2).sum(-1))


def test_block_scorer_matches_brute_force(spark):
    rng = np.random.RandomState(0)
    u, v = rng.randn(17, 5), rng.randn(23, 5)
    users, items = _vecs(spark, u), _vecs(spark, v)
    for metric in ("dot", "euclidean"):
        want = _brute(u, v, metric)
        for block in (1000, 6):  # one block, and several merged blocks
            got = retrieve.score_users(users, items, metric, top_n=4, block_items=block).collect()
            assert len(got) == 17 * 4
            for r in got:
                assert np.isclose(r.score, want[r.user_id, r.item_id])
            for uid in range(17):
                ranked = sorted(range(23), key=lambda j: (-want[uid, j] if metric == "dot" else want[uid, j], j))[:4]
                assert sorted(r.item_id for r in got if r.user_id == uid) == sorted(ranked)


def test_topk_unseen_exact_and_all_seen(spark):
    rng = np.random.RandomState(1)
    u, v = rng.randn(6, 3), rng.randn(8, 3)
    seen_rows = [(uid, j, 1.0) for uid in range(5) for j in range(8) if (uid + j) % 3 == 0]
    seen_rows += [(5, j, 1.0) for j in range(8)]  # user 5 has seen every item
    seen = interactions(spark, seen_rows, with_ts=False)
    got = retrieve.topk_unseen(_vecs(spark, u), _vecs(spark, v), seen, 3).collect()
    s = u @ v.T
    seen_set = {(a, b) for a, b, _ in seen_rows}
    for uid in range(5):
        want = sorted([j for j in range(8) if (uid, j) not in seen_set], key=lambda j: (-s[uid, j], j))[:3]
        assert [r.item_id for r in sorted((r for r in got if r.user_id == uid), key=lambda r: r["rank"])] == want
    assert not [r for r in got if r.user_id == 5]


def test_knn_budget_can_return_fewer(spark):
    u = np.array([[0.0, 0.0]])
    v = np.array([[0.1, 0.0], [0.2, 0.0], [0.3, 0.0], [5.0, 0.0]])
    seen = interactions(spark, [(0, 0, 1.0), (0, 1, 1.0)], with_ts=False)
    got = retrieve.knn_budget(_vecs(spark, u), _vecs(spark, v), seen, 3, budget=3).collect()
    assert [r.item_id for r in got] == [2]


def test_knn_lsh_recall_against_exact(spark):
    rng = np.random.RandomState(2)
    u, v = rng.randn(30, 4), rng.randn(60, 4)
    seen = interactions(spark, [(0, 0, 1.0)], with_ts=False)
    users, items = _vecs(spark, u), _vecs(spark, v)
    exact = {(r.user_id, r.item_id) for r in retrieve.topk_unseen(users, items, seen, 5, "euclidean").collect()}
    approx = {(r.user_id, r.item_id) for r in retrieve.knn_lsh(users, items, seen, 5, max_distance=10.0, bucket_length=4.0, num_tables=6).collect()}
    assert approx <= {(a, b) for a in range(30) for b in range(60)}
    assert len(exact & approx) / len(exact) >= 0.5


def test_knn_lsh_short_lists_are_exact(spark):
    rng = np.random.RandomState(3)
    u, v = rng.randn(20, 4), rng.randn(40, 4)
    seen = interactions(spark, [(0, 1, 1.0), (3, 5, 1.0)], with_ts=False)
    users, items = _vecs(spark, u), _vecs(spark, v)
    exact = sorted(tuple(r) for r in retrieve.topk_unseen(users, items, seen, 5, "euclidean").select("user_id", "item_id", "rank").collect())
    # hardly any pair shares a bucket: every user's list is short, so it is replaced by the exact one
    got = retrieve.knn_lsh(users, items, seen, 5, bucket_length=0.0001, num_tables=2)
    assert sorted(tuple(r) for r in got.select("user_id", "item_id", "rank").collect()) == exact


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
@pytest.mark.parametrize("max_broadcast_bytes", [1 << 20, 0])
def test_many_item_blocks_match_brute_force(spark, metric, max_broadcast_bytes):
    rng = np.random.RandomState(5)
    u, v = rng.randn(9, 3), rng.randn(23, 3)
    pairs = [(a, b, 1.0) for a in range(9) for b in range(23) if (a * 7 + b) % 4 == 0] + [(8, b, 1.0) for b in range(21)]
    seen = interactions(spark, list(dict.fromkeys(pairs)), with_ts=False)
    got = retrieve.topk_unseen(_vecs(spark, u), _vecs(spark, v), seen, 4, metric, block_items=5, max_broadcast_bytes=max_broadcast_bytes)
    gone = {(a, b) for a, b, _ in pairs}
    want = set()
    for a in range(9):
        value = u[a] @ v.T if metric == "dot" else -np.sqrt(((u[a] - v) ** 2).sum(axis=1))
        best = sorted((b for b in range(23) if (a, b) not in gone), key=lambda b: (-value[b], b))[:4]
        want |= {(a, b, r) for r, b in enumerate(best, 1)}
    assert {(r.user_id, r.item_id, r["rank"]) for r in got.collect()} == want
    assert "_1" not in got.columns


def test_no_items_or_users_give_no_rows(spark):
    users, items = _vecs(spark, np.ones((2, 2))), _vecs(spark, np.ones((3, 2)))
    seen = interactions(spark, [(0, 1, 1.0)], with_ts=False)
    assert retrieve.topk_unseen(users, items.limit(0), seen, 2).collect() == []
    assert retrieve.topk_unseen(users.limit(0), items, seen, 2).collect() == []


def test_bias_topk_matches_brute_force(spark):
    e = fx.events_interactions(spark, SF001)
    train, _ = prep.split_by_time(e)
    got = {(r.user_id, r.item_id, r["rank"]) for r in bias.bias_topk(train, 10).collect()}
    pdf = train.toPandas()
    um = pdf.groupby("user_id").rating.mean()
    im = pdf.groupby("item_id").rating.mean()
    seen = set(zip(pdf.user_id, pdf.item_id))
    want = set()
    for u in um.index:
        cands = sorted([i for i in im.index if (u, i) not in seen], key=lambda i: (-im[i], i))[:10]
        want |= {(u, i, r) for r, i in enumerate(cands, 1)}
    assert got == want


def test_bias_scores_are_mean_sum(spark):
    train = interactions(spark, [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 5.0)], with_ts=False)
    got = {(r.user_id, r.item_id): r.score for r in bias.bias_scores(train).collect()}
    assert got == {(2, 2): 2.0 + 5.0}
    assert bias.bias_score_pairs(train, interactions(spark, [(2, 2, 1.0)], with_ts=False)).first().score == 7.0


@pytest.mark.parametrize("name", ["candidates_dot", "knn_exact_budget", "knn_unseen_topk", "bias_topk"])
def test_recommendations_unseen_and_at_most_k(spark, name):
    import __spark_entry__ as entry
    from tastemap.plans.queries import Fixtures

    recs = entry.queries()[name](spark, SF001)
    train = Fixtures(spark, SF001).e_train
    assert recs.join(train, ["user_id", "item_id"], "left_semi").count() == 0
    assert recs.groupBy("user_id").count().filter(F.col("count") > 10).count() == 0
    assert recs.filter((F.col("rank") < 1) | (F.col("rank") > 10)).count() == 0


# ---- pruned blocks ---------------------------------------------------------------------------
class _Held:
    """Stands for a broadcast."""

    def __init__(self, value):
        self.value = value


def _users_batch(u, seen=None):
    import pyarrow as pa

    return pa.record_batch(
        {
            "id": pa.array(np.arange(len(u)), pa.int64()),
            "features": pa.array([list(map(float, x)) for x in u], pa.list_(pa.float64())),
            "seen": pa.array(seen or [[] for _ in u], pa.list_(pa.int64())),
        }
    )


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
def test_blocks_out_of_reach_are_skipped(metric):
    rng = np.random.RandomState(7)
    # clustered items: far clusters are out of reach; for dot, small norms are
    centers = rng.randn(40, 6) * 10
    v = np.concatenate([c + 0.1 * rng.randn(50, 6) for c in centers]) * (rng.rand(2000, 1) ** 4 if metric == "dot" else 1)
    u = centers[rng.randint(0, 40, 200)] + 0.1 * rng.randn(200, 6)
    items = retrieve.Items.of(np.arange(2000), v, metric, 50)
    assert all(b - a <= 50 for a, b in zip(items.starts[:-1], items.starts[1:]))
    stats = {"scored": 0, "skipped": 0}
    seen = [list(range(i % 30)) for i in range(200)]
    (uid, ids, key), = retrieve._best(metric, 5, None, _Held(items), stats)([_users_batch(u, seen)])
    assert stats["scored"] + stats["skipped"] == 200 * (len(items.starts) - 1)
    assert stats["skipped"] > (0.8 if metric == "euclidean" else 0.5) * 200 * (len(items.starts) - 1)
    want = -(u @ v.T) if metric == "dot" else np.sqrt(((u[:, None] - v[None]) ** 2).sum(-1))
    for i in range(200):
        free = np.setdiff1d(np.arange(2000), seen[i])
        best = free[np.argsort(want[i, free], kind="stable")][:5]
        assert list(ids[i]) == list(best)


def test_floors_hold_for_every_item_of_a_block():
    rng = np.random.RandomState(8)
    for metric in ("dot", "euclidean"):
        for scale in (1e-3, 1.0, 1e4):
            v, u = rng.randn(300, 4) * scale, rng.randn(50, 4) * scale
            items = retrieve.Items.of(np.arange(300), v, metric, 16)
            low = retrieve._floors(metric, u, items, 3)
            for b, (s, e) in enumerate(zip(items.starts[:-1], items.starts[1:])):
                assert (retrieve._keys(metric, u, items.mat[s:e], 3) >= low[:, [b]]).all()


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
@pytest.mark.parametrize("max_broadcast_bytes", [1 << 20, 0])
def test_rank_targets_match_brute_force(spark, metric, max_broadcast_bytes):
    rng = np.random.RandomState(9)
    u, v = rng.randint(-2, 3, (12, 3)).astype(float), rng.randint(-2, 3, (31, 3)).astype(float)  # many ties
    seen = [(a, b) for a in range(12) for b in range(31) if (a * 5 + b) % 6 == 0]
    targets = [(a, b) for a in range(12) for b in range(35) if (a + b) % 4 == 0] + [(99, 3)]  # also unknown users and items
    got = retrieve.rank_targets(
        _vecs(spark, u), _vecs(spark, v), interactions(spark, [(a, b, 1.0) for a, b in targets], with_ts=False),
        interactions(spark, [(a, b, 1.0) for a, b in seen], with_ts=False), metric, digits=6, block_items=7, max_broadcast_bytes=max_broadcast_bytes,
    ).collect()
    key = -(u @ v.T) if metric == "dot" else np.round(np.sqrt(((u[:, None] - v[None]) ** 2).sum(-1)), 6)
    gone = set(seen)
    assert sorted((r.user_id, r.item_id) for r in got) == sorted(targets)
    for r in got:
        a, b = r.user_id, r.item_id
        free = [j for j in range(31) if a < 12 and (a, j) not in gone]
        scored = b in free
        assert r.is_scored == scored and r.n_scored == len(free) and r.below == sum(j < b for j in free)
        if scored:
            assert r.above == sum((key[a, j], j) < (key[a, b], b) for j in free)


def test_rank_targets_shuffle_no_grid(spark):
    from tastemap.plans.queries import Fixtures

    f = Fixtures(spark, SF001)
    ranks = retrieve.rank_targets(f.vu, f.vi, f.e_test.select("user_id", "item_id"), f.e_train, "dot", 6)
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    # the scored block leaves its task as counts: nothing is exchanged between it and the final join on pairs
    # but rows of pairs, and no window ranks a grid
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_bias_topk_by_blocks_matches_broadcast(spark):
    f = fx.orders_interactions(spark, SF001)
    train, _ = prep.split_by_time(f)
    want = sorted(map(tuple, bias.bias_topk(train, 7).collect()))
    got = bias.bias_topk(train, 7, max_broadcast_items=0, block=4, rows_per_copy=3)
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(pos" not in plan  # no join on a position that every user has


def test_bias_topk_of_a_user_who_saw_all(spark):
    train = interactions(spark, [(1, i, 1.0 + i) for i in range(5)] + [(2, 3, 2.0), (2, 3, 4.0)], with_ts=False)
    got = {(r.user_id, r.item_id, r["rank"]) for r in bias.bias_topk(train, 3).collect()}
    assert got == {(2, 4, 1), (2, 2, 2), (2, 1, 3)}


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
def test_most_pairs_are_settled_in_single_precision(metric, monkeypatch):
    import pyarrow as pa

    # few pairs reach double precision, and lists and counts are those of all pairs in double precision
    rng = np.random.RandomState(11)
    u, v = rng.randn(40, 16), np.repeat(rng.randn(1500, 16), 2, axis=0)  # every vector twice: ties
    items, exact, scored = retrieve.Items.of(np.arange(3000), v, metric, 256), retrieve._pair_keys, []
    monkeypatch.setattr(retrieve, "_pair_keys", lambda m, a, b, d: scored.append(len(a)) or exact(m, a, b, d))
    seen = [sorted(rng.choice(3000, 30, replace=False).tolist()) for _ in range(40)]
    targets = [sorted(rng.choice(3000, 100 if i == 0 else 6, replace=False).tolist()) for i in range(40)]
    batch = _users_batch(u, seen)
    (_, ids, _), = retrieve._best(metric, 5, 6, _Held(items))([batch])
    counted = list(retrieve._counts(metric, 6, _Held(items), False)([batch.append_column("targets", pa.array(targets, pa.list_(pa.int64())))]))
    key = np.array([exact(metric, np.broadcast_to(x, v.shape), v, 6) for x in u])
    for i in range(40):
        key[i, seen[i]] = np.inf
        assert list(ids[i]) == list(np.argsort(key[i], kind="stable")[:5])
    for r in counted[0].to_pylist():
        k, j = key[r["user_id"]], r["item_id"]
        assert r["above"] == ((k < k[j]) | ((k == k[j]) & (np.arange(3000) < j) & ~np.isinf(k))).sum()
    assert sum(scored) < 0.2 * 40 * 3000


def test_numbers_out_of_single_precision_are_ranked(spark):
    u, v = np.array([[1e200, 1.0], [1e-200, 0.0]]), np.array([[1e90, 0.0], [2e90, 0.0], [-1e90, 5.0]])
    seen = interactions(spark, [(0, 1, 1.0)], with_ts=False)
    got = retrieve.topk_unseen(_vecs(spark, u), _vecs(spark, v), seen, 2)
    assert {(r.user_id, r.item_id, r["rank"]) for r in got.collect()} == {(0, 0, 1), (0, 2, 2), (1, 1, 1), (1, 0, 2)}
