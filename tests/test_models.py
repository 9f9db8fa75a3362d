import numpy as np
from pyspark.sql import functions as F

from conftest import interactions
from tastemap.operators import als, bias
from tastemap.operators.mlp import fit_mlp
from tastemap.plans import metrics


def _planted_rank2(spark, n_users=60, n_items=40, seed=0):
    rng = np.random.RandomState(seed)
    pu, pi = rng.randn(n_users, 2), rng.randn(n_items, 2)
    rows = [(u, i, float(pu[u] @ pi[i]) + 3.0, 0) for u in range(n_users) for i in range(n_items) if rng.rand() < 0.6]
    return interactions(spark, rows)


def test_als_seeded_is_deterministic(spark):
    df = _planted_rank2(spark)
    a = als.factors(als.fit_als(df, rank=2, max_iter=5, reg=0.01, seed=7, num_blocks=4))[1].orderBy("id").collect()
    b = als.factors(als.fit_als(df, rank=2, max_iter=5, reg=0.01, seed=7, num_blocks=4))[1].orderBy("id").collect()
    assert [list(r.features) for r in a] == [list(r.features) for r in b]


def test_als_beats_bias_on_planted_low_rank(spark):
    df = _planted_rank2(spark)
    train, test = df.randomSplit([0.8, 0.2], seed=1)
    m = als.fit_als(train, rank=2, max_iter=15, reg=0.01, seed=0, num_blocks=4)
    als_rmse = metrics.error_metrics(test, als.predict_pairs(m, test)).first().rmse
    bias_rmse = metrics.error_metrics(test, bias.bias_score_pairs(train, test)).first().rmse
    assert als_rmse < bias_rmse


def test_mlp_learns_planted_linear_target(spark):
    rng = np.random.RandomState(0)
    w = rng.randn(6)
    rows = []
    for n in range(3000):
        x = rng.randn(6)
        rows.append((n, n % 50, float(x @ w), [float(v) for v in x]))
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double, features array<double>")
    model, hist = fit_mlp(df, epochs=15, hidden=(16, 8), batch_size=64, lr=0.01, seed=0, num_partitions=4)
    h = hist.orderBy("epoch").collect()
    assert h[-1].loss < h[0].loss / 5
    assert h[-1].val_mae < 0.5
    model2, _ = fit_mlp(df, epochs=15, hidden=(16, 8), batch_size=64, lr=0.01, seed=0, num_partitions=4)
    assert np.array_equal(model.theta, model2.theta)
    assert model.evaluate(df).first().mse < 0.5


def test_mlp_item_side_paths_agree(spark):
    rng = np.random.RandomState(4)
    uvec, ivec = rng.randn(30, 3), rng.randn(12, 5)
    rows, full = [], []
    for n in range(1500):
        u, i = n % 30, (n * 7) % 12
        y = float(uvec[u].sum() - ivec[i][0])
        rows.append((u, i, y, [float(x) for x in uvec[u]]))
        full.append((u, i, y, [float(x) for x in np.concatenate([uvec[u], ivec[i]])]))
    schema = "user_id int, item_id int, rating double, features array<double>"
    items = spark.createDataFrame([(i, [float(x) for x in ivec[i]]) for i in range(12)], "id int, features array<double>")
    kw = dict(epochs=3, hidden=(8,), batch_size=32, seed=0, num_partitions=3)
    a, _ = fit_mlp(spark.createDataFrame(full, schema), **kw)
    b, _ = fit_mlp(spark.createDataFrame(rows, schema), item_side=items, **kw)
    c, _ = fit_mlp(spark.createDataFrame(rows, schema), item_side=items, max_item_side_bytes=0, **kw)
    assert b.item_ids is not None and c.item_ids is None
    assert np.allclose(a.theta, b.theta) and np.allclose(a.theta, c.theta)
    pa_ = {(r.user_id, r.item_id): r.score for r in a.predict(spark.createDataFrame(full[:50], schema)).collect()}
    pb = {(r.user_id, r.item_id): r.score for r in b.predict(spark.createDataFrame(rows[:50], schema)).collect()}
    assert pa_.keys() == pb.keys() and all(np.isclose(pa_[k], pb[k]) for k in pa_)


def test_mlp_sums_in_groups_agree(spark, monkeypatch):
    from tastemap.operators import mlp

    rng = np.random.RandomState(9)
    rows = []
    for n in range(800):
        x = rng.randn(5)
        rows.append((n, n % 7, float(x.sum()), [float(v) for v in x]))
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double, features array<double>")
    kw = dict(epochs=3, hidden=(6,), batch_size=32, seed=1, num_partitions=3)
    a, ha = fit_mlp(df, **kw)
    monkeypatch.setattr(mlp, "SUM_FAN_IN", 2)
    b, hb = fit_mlp(df, **kw)
    assert np.allclose(a.theta, b.theta)
    la = [r.loss for r in ha.orderBy("epoch").collect()]
    lb = [r.loss for r in hb.orderBy("epoch").collect()]
    assert np.allclose(la, lb)


def test_sum_of_many_partials(spark):
    from tastemap.operators import mlp

    n, size = 1100, mlp.CHUNK + 3
    rng = np.random.RandomState(0)
    rows, total = [], np.zeros(size)
    for part in range(n):
        w = rng.randn(size).round(6)
        total += w
        for c in (0, 1):
            a = [float(x) for x in w[c * mlp.CHUNK : (c + 1) * mlp.CHUNK][:3]] if size > 10_000 else [float(x) for x in w[c * mlp.CHUNK : (c + 1) * mlp.CHUNK]]
            rows.append((part, c, a, a, a, 1, 0.5, 0.25, 2, 1, 0.5, 0.5))
    parts = spark.createDataFrame(rows, mlp.EPOCH_SCHEMA).repartition(7)
    got = mlp._sum_partials(parts, n, size)
    again = mlp._sum_partials(parts.repartition(3), n, size)
    assert got["n"] == n and got["sse"] == n * 0.5 and got["steps"] == 2 * n
    assert np.allclose(got["w"][:3], total[:3]) and (got["w"] == again["w"]).all()


def test_als_and_mlp_do_not_depend_on_cores(spark):
    from tastemap.operators import als

    assert als.blocks_for(spark.range(10).selectExpr("id user_id", "id item_id", "1.0 rating")) == als.MIN_BLOCKS


def test_missing_tags_keep_rows(spark):
    from tastemap.operators.features import item_side_features
    from tests.conftest import interactions
    from tastemap.plans.pipelines import ann_nn, mf_nn

    tags = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.25), (2, 0, 1.0), (2, 1, 0.0)], "item_id int, tag_id int, relevance double")
    itf = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "id int, features array<double>")
    from tastemap.operators.features import item_tag_vectors

    side = {r.id: r.features for r in item_side_features(itf, item_tag_vectors(tags)).collect()}
    assert side == {0: [1, 0, 0.5, 0.25], 1: [1, 1, 0, 0], 2: [1, 2, 1, 0], 3: [1, 3, 0, 0]}
    assert {r.id for r in item_side_features(itf, item_tag_vectors(tags), "inner").collect()} == {0, 2}
    rng = np.random.RandomState(1)
    train = interactions(spark, [(u, i, float(rng.randint(1, 6)), 1) for u in range(12) for i in range(20) if (u + i) % 3])
    for fn, key in ((mf_nn, "k"), (ann_nn, "prerank_k")):
        r = fn(train, None, tags, 2, 0.1, rank=3, use_tags=True, epochs=1, **{key: 5})
        per = {x.user_id: x["count"] for x in r.recommendations.groupBy("user_id").count().collect()}
        assert per == {u: 5 for u in range(12)}
        assert r.recommendations.join(train, ["user_id", "item_id"], "left_semi").count() == 0


def test_mlp_in_one_task_is_reproducible(spark):
    rng = np.random.RandomState(4)
    rows = [(u, i, [float(x) for x in rng.randn(5)], float(rng.randn())) for u in range(20) for i in range(15)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, features array<double>, rating double")
    kw = dict(epochs=3, hidden=(6,), batch_size=1000, seed=1, validation_frac=0.0)
    one, h1 = fit_mlp(df, num_partitions=1, **kw)
    _, h2 = fit_mlp(df, num_partitions=2, **kw)
    assert h1.count() == h2.count() == 3
    # full batches: the order of rows does not matter, so the losses of the first epoch agree
    assert abs(h1.filter("epoch = 1").first().loss - h2.filter("epoch = 1").first().loss) < 0.5
    again, _ = fit_mlp(df.repartition(7), num_partitions=1, **kw)
    assert np.allclose(one.theta, again.theta, atol=1e-12)


def test_mlp_gradient_matches_finite_differences(spark):
    from tastemap.operators import mlp

    rng = np.random.RandomState(5)
    rows = [(0, 0, [float(x) for x in rng.randn(3)], float(rng.randn())) for _ in range(40)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, features array<double>, rating double").repartition(3)
    sizes = mlp.layer_sizes(3, (4,))
    theta = rng.randn(3 * 4 + 4 + 4 + 1)
    x, y = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    loss = lambda t: ((mlp.forward(x, mlp.unpack(t, sizes)) - y) ** 2).mean()
    got = {r.pos: r.grad for r in mlp.gradient(df, theta, (4,)).collect()}
    for p in range(len(theta)):
        step = np.zeros(len(theta))
        step[p] = 1e-6
        assert abs(got[p] - (loss(theta + step) - loss(theta - step)) / 2e-6) < 1e-5


def test_mlp_without_rows_keeps_its_weights(spark):
    df = spark.createDataFrame([], "user_id int, item_id int, features array<double>, rating double")
    model, hist = fit_mlp(df, epochs=2, hidden=(3,))
    assert hist.count() == 0 and len(model.theta) == 3 + 3 + 1


def test_full_batch_step_does_not_meet_in_one_task(spark, monkeypatch):
    from tastemap.operators import mlp

    rng = np.random.RandomState(6)
    rows = [(u, i, [float(x) for x in rng.randn(5)], float(rng.randn())) for u in range(30) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, features array<double>, rating double").repartition(5)
    kw = dict(hidden=(6,), epochs=3, batch_size=1 << 40, lr=0.1, seed=1, num_partitions=1)
    one, h1 = fit_mlp(df, **kw)
    monkeypatch.setattr(mlp, "MAX_TASK_BYTES", 0)
    monkeypatch.setattr(mlp, "_train_fn", None)  # the whole set in one task
    many, h2 = fit_mlp(df, **kw)
    assert np.allclose(one.theta, many.theta, atol=1e-9)
    assert np.allclose(h1.orderBy("epoch").toPandas(), h2.orderBy("epoch").toPandas())


def test_partitions_hold_rows_in_single_precision(spark, monkeypatch):
    from tastemap.operators import mlp

    kept, cut = [], mlp.cut_lineage
    monkeypatch.setattr(mlp, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    rows = [(u, i, [float(u), float(i), 1.0], float(u % 5)) for u in range(30) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, features array<double>, rating double")
    fit_mlp(df, epochs=1, hidden=(6,), num_partitions=3)
    assert sum(len(r.x) for r in kept[-1].collect()) == 600 * 3 * 4


def test_forward_expression_computes_a_layer_once(spark):
    from tastemap.operators.mlp import MLPModel, forward, unpack
    from tastemap.plans.model_queries import _forward

    rng = np.random.RandomState(2)
    sizes = [4, 5, 3, 1]
    model = MLPModel(rng.randn(4 * 5 + 5 + 5 * 3 + 3 + 3 + 1), sizes)
    x = rng.randn(10, 4)
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "features array<double>").select(_forward(model, "features").alias("y"))
    assert np.allclose([r.y for r in df.collect()], forward(x, unpack(model.theta, sizes)))
    # the input column is bound to a variable: no unit holds the layers below
    assert df._jdf.queryExecution().optimizedPlan().toString().count("features#") <= 3
