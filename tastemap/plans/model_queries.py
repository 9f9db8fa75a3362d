"""Model, re-ranker, pipeline and tuning queries. Fitted values of iterative models (ALS, the MLP)
cannot be written in SQL, so each query fits and applies the model to its whole input and returns
the properties that any right result has, computed from the fitted output: SQL states them."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from tastemap.functions.vectors import dot
from tastemap.operators import als, retrieve
from tastemap.operators.features import nn_features
from tastemap.operators.mlp import MLPModel, fit_mlp, gradient, layer_sizes, unpack
from tastemap.plans import metrics, pipelines, tuning
from tastemap.operators.profile import groups
from tastemap.plans.queries import E_TRAIN_USER_BOUNDS, K, Fixtures, _pairs, query
from tastemap.schema import ITEM, RATING, SCORE, USER
from tastemap.session import checkpoint_dir, cut_lineage

# Published model settings.
ALS_RANK, ALS_ITER, ALS_REG = 10, 25, 0.1  # MF baseline
MFNN = dict(max_iter=15, reg=0.1, k=30, rank=10)  # MF-NN without tags
ANNNN = dict(max_iter=2, reg=0.1, prerank_k=20, rank=20, epochs=50)  # ANN-NN without tags
ANN_KNN = dict(max_iter=5, rank=20)  # nearest-item recommender
EPOCHS_TAGS = 32  # of both hybrids, and of MF-NN without tags
LSH_RECALL = 0.9


def _als(f: Fixtures, rank=ALS_RANK, max_iter=ALS_ITER, reg=ALS_REG):
    key = f"als_{rank}_{max_iter}_{reg}"
    return f._get(key, lambda: als.fit_als(f.e_train, rank, max_iter, reg, seed=0))


def _finite(c) -> F.Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) < 1e30), F.lit(False))


def _list_check(recs, train):
    """Per user: list length, whether no item was seen in train, and whether ranks are 1..n with scores
    that exist."""
    seen = train.select(USER, ITEM).withColumn("_seen", F.lit(1))
    rows = recs.join(seen, [USER, ITEM], "left")
    return rows.groupBy(USER).agg(
        F.count(F.lit(1)).alias("n_items"),
        (F.count("_seen") == 0).alias("all_unseen"),
        (F.countDistinct(ITEM) == F.count(F.lit(1))).alias("items_differ"),
        ((F.min("rank") == 1) & (F.max("rank") == F.count(F.lit(1))) & (F.countDistinct("rank") == F.count(F.lit(1)))).alias("ranks_complete"),
        F.min(_finite(F.col(SCORE)).cast("int")).cast("boolean").alias("scores_finite"),
    )


def _with_optimal(checked, recs, uf, itf, train, metric: str):
    """Adds ``optimal``: every listed item's rank is one more than the number of unseen items that score
    better, which are counted, not listed."""
    recs = cut_lineage(recs.select(USER, ITEM, "rank"))
    counted = retrieve.rank_targets(uf, itf, recs, train, metric)
    same = counted.join(recs, [USER, ITEM]).groupBy(USER).agg(F.min((F.col("is_scored") & (F.col("above") + 1 == F.col("rank"))).cast("int")).cast("boolean").alias("optimal"))
    return checked.join(same, USER)


def _with_rerank(checked, r: pipelines.HybridResult, k: int):
    """Adds ``reranked``: the list is what SQL makes of the emitted candidate scores (the candidates that
    fewer than k others of the user beat, placed by how many do)."""
    better = (F.col("b.score") > F.col("a.score")) | ((F.col("b.score") == F.col("a.score")) & (F.col("b.item_id") < F.col("a.item_id")))
    s = r.scored.select(USER, ITEM, SCORE)
    beaten = s.alias("a").join(s.alias("b"), (F.col("a.user_id") == F.col("b.user_id")) & better, "left")
    place = beaten.groupBy(F.col("a.user_id").alias(USER), F.col("a.item_id").alias(ITEM)).agg((F.count("b.item_id") + 1).alias("place")).filter(F.col("place") <= k)
    both = place.join(r.recommendations.select(USER, ITEM, "rank"), [USER, ITEM], "full")
    right = F.coalesce(F.col("place") == F.col("rank"), F.lit(False)).cast("int")
    return checked.join(both.groupBy(USER).agg(F.min(right).cast("boolean").alias("reranked")), USER)


def _solves(train, own, of: str, other, by: str):
    """(id, solves): whether each factor of ``own`` solves its normal equation against the factors ``other``
    that the step read, sum (u.v - r) v + reg * n * u = 0, up to the solver's single precision."""
    u, v = own.select(F.col("id").alias(of), F.col("features").alias("_u")), other.select(F.col("id").alias(by), F.col("features").alias("_v"))
    rows = train.join(u, of).join(v, by).withColumn("_e", dot("_u", "_v") - F.col(RATING))
    parts = rows.select(of, "_u", F.posexplode("_v").alias("d", "x"), "_e").withColumn("_ud", F.element_at("_u", F.col("d") + 1).cast("double"))
    per = parts.groupBy(of, "d").agg(
        F.abs(F.sum(F.col("_e") * F.col("x")) + ALS_REG * F.count(F.lit(1)) * F.first("_ud")).alias("left"),
        F.sum(F.abs(F.col("_e") * F.col("x")) + F.abs(F.col("x"))).alias("size"),
    )
    return per.groupBy(F.col(of).alias("id")).agg((F.max(F.col("left") / (F.col("size") + 1e-9)) < 1e-3).alias("solves"))


@query("als_user_factors")
def q_als_user_factors(f: Fixtures):
    """ALS ends with the user step, so each user's factors solve that user's normal equation against
    the item factors."""
    uf, itf = als.factors(_als(f))
    return uf.select("id", F.size("features").cast("long").alias("dim")).join(_solves(f.e_train, uf, USER, itf, ITEM), "id")


@query("als_item_factors")
def q_als_item_factors(f: Fixtures):
    """The last item step read the user factors of the iteration before: those of a fit that is one
    iteration shorter."""
    itf, before = als.factors(_als(f))[1], als.factors(_als(f, max_iter=ALS_ITER - 1))[0]
    return itf.select("id", F.size("features").cast("long").alias("dim")).join(_solves(f.e_train, itf, ITEM, before, USER), "id")


@query("als_predict_pairs")
def q_als_predict_pairs(f: Fixtures):
    uf, itf = als.factors(_als(f))
    got = als.predict_pairs(_als(f), _pairs(f.e_test)).select(USER, ITEM, RATING, SCORE)
    got = got.join(uf.select(F.col("id").alias(USER), F.col("features").alias("_u")), USER).join(itf.select(F.col("id").alias(ITEM), F.col("features").alias("_v")), ITEM)
    return got.select(USER, ITEM, RATING, (F.abs(dot("_u", "_v") - F.col(SCORE)) < 1e-4).alias("is_dot_product"))


@query("candidates_als")
def q_candidates_als(f: Fixtures):
    uf, itf = als.factors(_als(f))
    recs = retrieve.topk_unseen(uf, itf, f.e_train, K, "dot")
    return _with_optimal(_list_check(recs, f.e_train), recs, uf, itf, f.e_train, "dot")


@query("knn_als")
def q_knn_als(f: Fixtures):
    uf, itf = als.factors(_als(f, ANN_KNN["rank"], ANN_KNN["max_iter"]))
    recs = retrieve.topk_unseen(uf, itf, f.e_train, K, "euclidean")
    return _with_optimal(_list_check(recs, f.e_train), recs, uf, itf, f.e_train, "euclidean")


@query("knn_lsh")
def q_knn_lsh(f: Fixtures):
    """The approximate lists, and whether they hold at least nine tenths of the exact ones."""
    found = cut_lineage(retrieve.knn_lsh(f.vu, f.vi_scaled, f.e_train, K, bucket_length=2.0, num_tables=4))
    exact = retrieve.topk_unseen(f.vu, f.vi_scaled, f.e_train, K, "euclidean").select(USER, ITEM)
    hit = exact.join(found.select(USER, ITEM, F.lit(1).alias("_hit")), [USER, ITEM], "left").agg(F.count("_hit"), F.count(F.lit(1))).first()
    return _list_check(found, f.e_train).withColumn("recall_ok", F.lit(hit[0] >= LSH_RECALL * hit[1]))


def _mlp(f: Fixtures):
    def build():
        rows = nn_features(_pairs(f.e_train), f.vu, f.vi)
        return fit_mlp(rows, RATING, "features", (20, 8), epochs=32, batch_size=256, seed=0)

    return f._get("mlp", build)


@query("mlp_fit_history")
def q_mlp_fit_history(f: Fixtures):
    """Every epoch's figures exist, and training lowers the loss: the last is below the first."""
    hist = _mlp(f)[1]
    loss = [r["loss"] for r in hist.orderBy("epoch").collect()]
    return hist.withColumn("loss_falls", F.lit(loss[-1] < loss[0])).select("epoch", "loss_falls", *[(_finite(F.col(c)) & (F.col(c) >= 0)).alias(f"{c}_ok") for c in ("loss", "mae", "val_loss", "val_mae")])


def fixed_theta(sizes: list[int]) -> list[float]:
    """Fixed weights of a network: ((7919 p) mod 201 - 100) / 1000 at position p."""
    n = sum(a * b + b for a, b in zip(sizes[:-1], sizes[1:]))
    return [((7919 * p) % 201 - 100) / 1000 for p in range(n)]


# A small network over the fixed vectors, whose passes SQL can follow.
STEP_HIDDEN, STEP_LR, V_DIM = (4, 2), 0.1, 128


@query("mlp_forward")
def q_mlp_forward(f: Fixtures):
    """The forward pass on fixed weights."""
    sizes = layer_sizes(V_DIM, STEP_HIDDEN)
    out = MLPModel(np.array(fixed_theta(sizes)), sizes).predict(nn_features(_pairs(f.e_test), f.vu, f.vi))
    return out.select(USER, ITEM, RATING, F.round(SCORE, 6).alias(SCORE))


@query("mlp_gradient")
def q_mlp_gradient(f: Fixtures):
    """The full gradient at fixed weights over the train set."""
    rows = nn_features(_pairs(f.e_train), f.vu, f.vi)
    return gradient(rows, fixed_theta(layer_sizes(V_DIM, STEP_HIDDEN)), STEP_HIDDEN).select("pos", (F.round("grad", 6) + 0.0).alias("grad"))


@query("mlp_step")
def q_mlp_step(f: Fixtures):
    """One training step from fixed weights with the whole train set as the batch: the weights after it."""
    rows = nn_features(_pairs(f.e_train), f.vu, f.vi)
    theta = fixed_theta(layer_sizes(V_DIM, STEP_HIDDEN))
    model, _ = fit_mlp(rows, RATING, "features", STEP_HIDDEN, epochs=1, batch_size=1 << 40, lr=STEP_LR, validation_frac=0.0, num_partitions=1, theta=theta)
    weights = f.spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.theta)], "pos long, weight double")
    return weights.select("pos", F.round("weight", 5).alias("weight"))


def _forward(model: MLPModel, features: str) -> F.Column:
    """The forward pass of fitted weights as array expressions."""
    h = F.col(features)
    layers = unpack(model.theta, model.sizes)
    for i, (w, b) in enumerate(layers):
        units = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in w[:, j]]).alias("w"), F.lit(float(b[j])).alias("b")) for j in range(len(b))])
        h = _layer(units, h)
        if i < len(layers) - 1:
            h = F.transform(h, lambda x: F.greatest(x, F.lit(0.0)))
    return h[0]


def _layer(units: F.Column, h: F.Column) -> F.Column:
    # the layers below are bound to a variable, or every unit would compute them again
    return F.transform(F.array(h), lambda x: F.transform(units, lambda u: dot(x, u["w"]) + u["b"]))[0]


@query("mlp_scores")
def q_mlp_scores(f: Fixtures):
    """Every score is the fitted weights' forward pass, computed by array expressions instead of the tasks."""
    model = _mlp(f)[0]
    got = model.predict(nn_features(_pairs(f.e_test), f.vu, f.vi))
    return got.select(USER, ITEM, RATING, F.coalesce(F.abs(F.col(SCORE) - _forward(model, "features")) < 1e-6, F.lit(False)).alias("is_forward_pass"))


@query("mlp_eval")
def q_mlp_eval(f: Fixtures):
    """The evaluation against the model's own scores: n, and MSE and MAE recomputed from them."""
    model, rows = _mlp(f)[0], nn_features(_pairs(f.e_test), f.vu, f.vi)
    err = F.col(SCORE) - F.col(RATING)
    own = model.predict(rows).agg(F.avg(err * err).alias("mse2"), F.avg(F.abs(err)).alias("mae2")).first()
    return model.evaluate(rows, RATING).select(
        "n", (F.abs(F.col("mse") - own["mse2"]) < 1e-9).alias("mse_ok"), (F.abs(F.col("mae") - own["mae2"]) < 1e-9).alias("mae_ok")
    )


@query("pipeline_mf_nn")
def q_pipeline_mf_nn(f: Fixtures):
    r = pipelines.mf_nn(f.e_train, f.e_test, f.t, MFNN["max_iter"], MFNN["reg"], MFNN["k"], MFNN["rank"], final_k=K)
    return _with_rerank(_list_check(r.recommendations, f.e_train), r, K)


@query("pipeline_mf_nn_tags")
def q_pipeline_mf_nn_tags(f: Fixtures):
    r = pipelines.mf_nn(f.e_train, f.e_test, f.t, MFNN["max_iter"], MFNN["reg"], MFNN["k"], MFNN["rank"], final_k=K, use_tags=True)
    return _with_rerank(_list_check(r.recommendations, f.e_train), r, K)


@query("pipeline_ann_nn")
def q_pipeline_ann_nn(f: Fixtures):
    r = pipelines.ann_nn(
        f.e_train, f.e_test, f.t, ANNNN["max_iter"], ANNNN["reg"], ANNNN["prerank_k"], ANNNN["rank"], K, epochs=ANNNN["epochs"]
    )
    return _with_rerank(_list_check(r.recommendations, f.e_train), r, K)


@query("pipeline_comparison")
def q_pipeline_comparison(f: Fixtures):
    """The evaluation suite (recall@10, coverages at 1, NDCG, recall by activity bucket) for every
    model of the published comparison, with its published settings. Each value lies in [0, 1]."""
    cat_pos = cut_lineage(metrics.catalogue_positions(f.e_test))
    grouped = groups(f.e_train, USER, E_TRAIN_USER_BOUNDS)
    dot = lambda u, i: metrics.ranks_of_vectors(f.e_test, u, i, f.e_train, "dot", cat_pos=cat_pos)
    listed = lambda s: cut_lineage(metrics.ranks_of_scores(f.e_test, s, cat_pos))
    knn = retrieve.topk_unseen(*als.factors(_als(f, ANN_KNN["rank"], ANN_KNN["max_iter"])), f.e_train, K, "euclidean")
    ranks = {"bias": f.bias_ranks(cat_pos), "mf": dot(*als.factors(_als(f))), "ann": listed(metrics.ranks_as_scores(knn))}
    mf = dict(max_iter=MFNN["max_iter"], reg=MFNN["reg"], k=MFNN["k"], rank=MFNN["rank"], final_k=None, epochs=EPOCHS_TAGS)
    ann = dict(max_iter=ANNNN["max_iter"], reg=ANNNN["reg"], prerank_k=ANNNN["prerank_k"], rank=ANNNN["rank"], k_items=None)
    for tags in (False, True):
        end = "_tags" if tags else ""
        ranks["mf_nn" + end] = listed(pipelines.mf_nn(f.e_train, None, f.t, use_tags=tags, **mf).scored)
        ranks["ann_nn" + end] = listed(pipelines.ann_nn(f.e_train, None, f.t, use_tags=tags, epochs=EPOCHS_TAGS if tags else ANNNN["epochs"], **ann).scored)
    out = None
    for name, r in ranks.items():
        rows = metrics.evaluate_ranks(f.e_test, r, name, K, 1, grouped)
        out = rows if out is None else out.unionByName(rows)
    return out


def _fresh(f: Fixtures, name: str) -> str:
    return f"{checkpoint_dir(f.spark).rstrip('/')}/tuning/{name}-{uuid.uuid4().hex}"


def _grid_check(results, keys: list[str], metric: str, maximize: bool):
    """Every point with whether its metric exists and is in range, and whether ``is_best`` marks one
    point, with the best metric."""
    results = cut_lineage(results)
    top = results.agg((F.max if maximize else F.min)(metric).alias("m"), F.count(F.when(F.col("is_best"), 1)).alias("n")).first()
    right = F.lit(top["n"] == 1) & (~F.col("is_best") | (F.col(metric) == F.lit(top["m"])))
    in_range = _finite(F.col(metric)) & (F.col(metric) >= 0) & (F.col(metric) <= (1.0 if maximize else 1e6))
    return results.select(*[F.col(k).cast("double" if k == "reg" else "int").alias(k) for k in keys], in_range.alias("metric_ok"), right.alias("best_ok"))


@query("tune_als_cv")
def q_tune_als_cv(f: Fixtures):
    return _grid_check(tuning.tune_als_cv(f.e_train), ["max_iter", "reg", "rank"], "rmse", False)


@query("tune_knn_grid")
def q_tune_knn_grid(f: Fixtures):
    return _grid_check(tuning.tune_knn_grid(f.e_train, path=_fresh(f, "knn")), ["max_iter", "rank"], "recall", True)


@query("tune_ann_nn_grid")
def q_tune_ann_nn_grid(f: Fixtures):
    return _grid_check(tuning.tune_ann_nn_grid(f.e_train, path=_fresh(f, "ann_nn")), ["max_iter", "rank", "prerank_k"], "recall", True)


@query("tune_mf_nn_grid")
def q_tune_mf_nn_grid(f: Fixtures):
    return _grid_check(tuning.tune_mf_nn_grid(f.e_train, path=_fresh(f, "mf_nn")), ["max_iter", "reg", "k", "rank"], "mse", False)


@query("tune_mf_nn_grid_tags")
def q_tune_mf_nn_grid_tags(f: Fixtures):
    return _grid_check(tuning.tune_mf_nn_grid(f.e_train, f.t, use_tags=True, path=_fresh(f, "mf_nn_tags")), ["max_iter", "reg", "k", "rank"], "mse", False)


@query("pipeline_ann_nn_p")
def q_pipeline_ann_nn_p(f: Fixtures):
    """ANN-NN (published no-tag settings) on the sparse order-line interactions: the scale class
    of the published sample (hundreds of thousands of ratings, thousands of users and items)."""
    r = pipelines.ann_nn(
        f.p_train, f.p_test, None, ANNNN["max_iter"], ANNNN["reg"], ANNNN["prerank_k"], ANNNN["rank"], K, epochs=ANNNN["epochs"]
    )
    return _with_rerank(_list_check(r.recommendations, f.p_train), r, K)


@query("pipeline_ann_nn_tags")
def q_pipeline_ann_nn_tags(f: Fixtures):
    """ANN-NN with tag features (the published final configuration: 32 epochs, 256-64-8 net)."""
    r = pipelines.ann_nn(
        f.e_train, f.e_test, f.t, ANNNN["max_iter"], ANNNN["reg"], ANNNN["prerank_k"], ANNNN["rank"], K, use_tags=True, epochs=32
    )
    return _with_rerank(_list_check(r.recommendations, f.e_train), r, K)


@query("pipeline_ann_nn_tags_p")
def q_pipeline_ann_nn_tags_p(f: Fixtures):
    """The published final configuration on the sparse order-line interactions: a catalogue of thousands."""
    r = pipelines.ann_nn(
        f.p_train, f.p_test, f.t, ANNNN["max_iter"], ANNNN["reg"], ANNNN["prerank_k"], ANNNN["rank"], K, use_tags=True, epochs=EPOCHS_TAGS
    )
    return _with_rerank(_list_check(r.recommendations, f.p_train), r, K)
