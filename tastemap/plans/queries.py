"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
fixture tables. Column names match the oracle SQL in :mod:`tastemap.plans.oracle`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.functions.vectors import array_sum, dot
from tastemap.operators import bias, masks, prep, profile, retrieve
from tastemap.operators.features import item_tag_vectors, nn_features
from tastemap.plans import metrics
from tastemap.schema import ITEM, RATING, SCORE, TS, USER
from tastemap.session import checkpoint_dir, cut_lineage
from tastemap.sources import csv
from tastemap.sources import fixtures as fx

# Sampling parameters, the same for every input.
SAMPLE_PARAMS = dict(item_thresh=25, item_sample_n=50, user_thresh=0, user_sample_n=50, seed=0)
# Bucket bounds for the fixtures.
P_USER_BOUNDS = [5, 10, 30, 40, 50, 100]
P_ITEM_BOUNDS = [20, 25, 30, 35, 40, 100]
E_TRAIN_USER_BOUNDS = [30, 35, 40, 45, 100]
ACTIVE_ITEM_THRESH = 30
ACTIVE_USER_THRESH = 20
PIVOT_BLOCK = 1000  # users in a row of the whole pivot
K = 10
K_RECALL = 5
KNN_BUDGET = 15  # k + 1 + 5 neighbours minus the user's own point
DIGITS = 6  # scores are rounded before ranking so any engine orders them identically


class Fixtures:
    """Lazily built fixture frames for one (session, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.d = spark, sf_dir
        self._cache: dict[str, object] = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def e(self) -> DataFrame:
        return self._get("e", lambda: fx.events_interactions(self.spark, self.d))

    @property
    def p(self) -> DataFrame:
        return self._get("p", lambda: fx.orders_interactions(self.spark, self.d))

    @property
    def t(self) -> DataFrame:
        return self._get("t", lambda: fx.item_tags(self.spark, self.d))

    def _split(self, which: str):
        return self._get(f"split_{which}", lambda: prep.split_by_time(getattr(self, which)))

    @property
    def e_train(self) -> DataFrame:
        return self._split("e")[0]

    @property
    def e_test(self) -> DataFrame:
        return self._split("e")[1]

    @property
    def p_train(self) -> DataFrame:
        return self._split("p")[0]

    @property
    def p_test(self) -> DataFrame:
        return self._split("p")[1]

    @property
    def vu(self) -> DataFrame:
        """A fixed vector for every user of E's train set."""
        return fx.fixed_user_vectors(self.spark, self.d, self.e_train)

    @property
    def vi(self) -> DataFrame:
        return fx.fixed_item_vectors(self.spark, self.d, self.e)

    @property
    def vi_scaled(self) -> DataFrame:
        return fx.fixed_item_vectors(self.spark, self.d, self.e, scaled=True)

    @property
    def vu_p(self) -> DataFrame:
        """A fixed vector for every user of P's train set."""
        return fx.fixed_user_vectors(self.spark, self.d, self.p_train)

    @property
    def vi_p(self) -> DataFrame:
        return fx.fixed_item_vectors(self.spark, self.d, self.p)

    @property
    def vi_p_scaled(self) -> DataFrame:
        return fx.fixed_item_vectors(self.spark, self.d, self.p, scaled=True)

    def dot_pred(self) -> DataFrame:
        return retrieve.dot_scores(self.vu, self.vi, self.e_train, digits=DIGITS)

    def dot_lists(self, k: int) -> DataFrame:
        """Each test user's k best unseen test-catalogue items by dot product: what top-k metrics
        need, without the user x item grid."""
        users = self.vu.join(self.e_test.select(F.col(USER).alias("id")).distinct(), "id", "left_semi")
        items = self.vi.join(masks.catalogue(self.e_test).select(F.col(ITEM).alias("id")), "id", "left_semi")
        return retrieve.topk_unseen(users, items, self.e_train, k, "dot", digits=DIGITS).drop("rank")

    def dot_ranks(self, cat_pos: DataFrame | None = None) -> DataFrame:
        """The rank of every test pair by dot product, counted in blocks."""
        return metrics.ranks_of_vectors(self.e_test, self.vu, self.vi, self.e_train, "dot", DIGITS, cat_pos)

    def bias_ranks(self, cat_pos: DataFrame | None = None) -> DataFrame:
        return metrics.ranks_of_vectors(self.e_test, *bias.bias_vectors(self.e_train), self.e_train, "dot", DIGITS, cat_pos)

    def bias_pred(self) -> DataFrame:
        return bias.bias_scores(self.e_train).withColumn(SCORE, F.round(SCORE, DIGITS))

    def knn_recs(self) -> DataFrame:
        return retrieve.topk_unseen(self.vu, self.vi_scaled, self.e_train, K, "euclidean", digits=DIGITS)


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(USER, ITEM, RATING)


Q = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Q] = {}


def query(name: str):
    def deco(fn):
        _REGISTRY[name] = lambda spark, d: fn(Fixtures(spark, d))
        return fn

    return deco


# ---- sources --------------------------------------------------------------------------
@query("src_interactions")
def q_src_interactions(f: Fixtures):
    return _pairs(f.p)


@query("src_interactions_events")
def q_src_interactions_events(f: Fixtures):
    return _pairs(f.e)


@query("src_item_tags")
def q_src_item_tags(f: Fixtures):
    return f.t


def _csv_folder(f: Fixtures, name: str) -> str:
    return f"{checkpoint_dir(f.spark).rstrip('/')}/csv/{name}-{uuid.uuid4().hex}"


@query("src_ratings_csv")
def q_src_ratings_csv(f: Fixtures):
    """All of P written in the ratings layout and scanned back."""
    path = _csv_folder(f, "ratings")
    csv.write_ratings_csv(f.p.withColumn(TS, F.unix_seconds(F.col(TS).cast("timestamp"))), path)
    return csv.read_ratings_csv(f.spark, path)


@query("src_tags_csv")
def q_src_tags_csv(f: Fixtures):
    """All of T written in the tags layout and scanned back."""
    path = _csv_folder(f, "tags")
    csv.write_tags_csv(f.t, path)
    return csv.read_tags_csv(f.spark, path)


# ---- projection / filter / reshape ------------------------------------------------------
@query("tags_of_sampled_items")
def q_tags_of_sampled_items(f: Fixtures):
    sample = prep.sample_rsmr(f.p, **SAMPLE_PARAMS)
    return f.t.join(sample.select(ITEM).distinct(), ITEM, "left_semi")


@query("active_items")
def q_active_items(f: Fixtures):
    return prep.count_by(f.p, ITEM).filter(F.col("n_ratings") > ACTIVE_ITEM_THRESH)


@query("active_users")
def q_active_users(f: Fixtures):
    return prep.count_by(f.p, USER).filter(F.col("n_ratings") > ACTIVE_USER_THRESH)


@query("id_dictionary")
def q_id_dictionary(f: Fixtures):
    return profile.id_dictionary(f.p, USER)


@query("pivot_user_blocks")
def q_pivot_user_blocks(f: Fixtures):
    return profile.pivot_user_blocks(f.e, PIVOT_BLOCK)


@query("matrix_shape")
def q_matrix_shape(f: Fixtures):
    return profile.matrix_shape(f.p)


@query("align_to_catalogue")
def q_align_to_catalogue(f: Fixtures):
    return masks.align_to_catalogue(f.dot_pred(), f.e_test)


@query("align_lists")
def q_align_lists(f: Fixtures):
    """Lists over all items, restricted to the test catalogue: what an evaluation reads of them."""
    lists = retrieve.topk_unseen(f.vu_p, f.vi_p_scaled, f.p_train, K, "euclidean", digits=DIGITS)
    return masks.align_to_catalogue(lists, f.p_test).select(USER, ITEM, "rank")


@query("unseen_pairs")
def q_unseen_pairs(f: Fixtures):
    return _pairs(masks.unseen(f.e, f.e_train))


# ---- sampling / splitting ---------------------------------------------------------------
@query("sample_rsmr")
def q_sample_rsmr(f: Fixtures):
    return _pairs(prep.sample_rsmr(f.p, **SAMPLE_PARAMS))


@query("draw_items")
def q_draw_items(f: Fixtures):
    sp = SAMPLE_PARAMS
    return prep.draw_ids(prep.active_ids(f.p, ITEM, sp["item_thresh"]), ITEM, sp["item_sample_n"], sp["seed"], "items")


@query("sample_totals")
def q_sample_totals(f: Fixtures):
    return prep.sample_totals(prep.sample_rsmr(f.p, **SAMPLE_PARAMS))


@query("split_train")
def q_split_train(f: Fixtures):
    return _pairs(f.e_train)


@query("split_test")
def q_split_test(f: Fixtures):
    return _pairs(f.e_test)


@query("split_train_p")
def q_split_train_p(f: Fixtures):
    return _pairs(f.p_train)


@query("split_test_p")
def q_split_test_p(f: Fixtures):
    return _pairs(f.p_test)


@query("split_validation")
def q_split_validation(f: Fixtures):
    return _pairs(prep.split_by_time(f.p_train)[1])


@query("split_holdout")
def q_split_holdout(f: Fixtures):
    return _pairs(prep.split_holdout(f.e_train, 0.1, seed=0)[1])


# ---- profiling ---------------------------------------------------------------------------
@query("user_freq")
def q_user_freq(f: Fixtures):
    return profile.describe(f.p)[0]


@query("item_freq")
def q_item_freq(f: Fixtures):
    return profile.describe(f.p)[1]


@query("user_groups")
def q_user_groups(f: Fixtures):
    return profile.groups(f.p, USER, P_USER_BOUNDS)


@query("item_groups")
def q_item_groups(f: Fixtures):
    return profile.groups(f.p, ITEM, P_ITEM_BOUNDS)


@query("user_group_counts")
def q_user_group_counts(f: Fixtures):
    return profile.group_counts(profile.groups(f.p, USER, P_USER_BOUNDS))


@query("item_group_counts")
def q_item_group_counts(f: Fixtures):
    return profile.group_counts(profile.groups(f.p, ITEM, P_ITEM_BOUNDS))


@query("freq_histogram_users")
def q_freq_histogram_users(f: Fixtures):
    return _round(profile.histogram(profile.describe(f.p)[0], "n_ratings", 1000), "bin_lo", "bin_hi")


@query("freq_histogram_items")
def q_freq_histogram_items(f: Fixtures):
    return _round(profile.histogram(profile.describe(f.p)[1], "n_ratings", 5000), "bin_lo", "bin_hi")


@query("recall_histogram")
def q_recall_histogram(f: Fixtures):
    return _round(metrics.recall_histogram(f.e_test, f.dot_lists(K_RECALL), K_RECALL, 10), "bin_lo", "bin_hi")


# ---- models and scoring --------------------------------------------------------------------
@query("bias_user_mean")
def q_bias_user_mean(f: Fixtures):
    return _round(bias.bias_fit(f.e_train)[0], "user_mean")


@query("bias_item_mean")
def q_bias_item_mean(f: Fixtures):
    return _round(bias.bias_fit(f.e_train)[1], "item_mean")


@query("bias_scores")
def q_bias_scores(f: Fixtures):
    return f.bias_pred()


@query("bias_score_pairs")
def q_bias_score_pairs(f: Fixtures):
    return _round(bias.bias_score_pairs(f.e_train, f.e_test), SCORE)


@query("bias_topk")
def q_bias_topk(f: Fixtures):
    return _round(bias.bias_topk(f.e_train, K), SCORE)


@query("dot_scores")
def q_dot_scores(f: Fixtures):
    return f.dot_pred()


@query("candidates_dot")
def q_candidates_dot(f: Fixtures):
    return retrieve.topk_unseen(f.vu, f.vi, f.e_train, K, "dot", digits=DIGITS)


@query("candidates_dot_p")
def q_candidates_dot_p(f: Fixtures):
    return retrieve.topk_unseen(f.vu_p, f.vi_p, f.p_train, K, "dot", digits=DIGITS)


@query("knn_unseen_topk_p")
def q_knn_unseen_topk_p(f: Fixtures):
    return retrieve.topk_unseen(f.vu_p, f.vi_p_scaled, f.p_train, K, "euclidean", digits=DIGITS)


@query("bias_topk_p")
def q_bias_topk_p(f: Fixtures):
    # the block lookup that long ranked lists take, without the broadcast
    return _round(bias.bias_topk(f.p_train, K, max_broadcast_items=0), SCORE)


@query("knn_exact_budget")
def q_knn_exact_budget(f: Fixtures):
    # the published neighbour budget, kept for parity: lists may be short
    return retrieve.knn_budget(f.vu, f.vi_scaled, f.e_train, K, KNN_BUDGET, digits=DIGITS)


@query("knn_unseen_topk")
def q_knn_unseen_topk(f: Fixtures):
    return f.knn_recs()


@query("item_tag_vectors")
def q_item_tag_vectors(f: Fixtures):
    tv = item_tag_vectors(f.t)
    weighted = F.aggregate(
        F.transform("tag_vec", lambda x, i: x * (i + 1)), F.lit(0.0).cast("double"), lambda a, v: a + v
    )
    return tv.select(ITEM, F.size("tag_vec").cast("long").alias("n_tags"), F.round(weighted, DIGITS).alias("weighted_sum"))


@query("nn_features")
def q_nn_features(f: Fixtures):
    feats = nn_features(_pairs(f.e_train), f.vu, f.vi, item_tag_vectors(f.t))
    return feats.select(
        USER, ITEM, RATING, F.size("features").cast("long").alias("dim"), F.round(array_sum("features"), DIGITS).alias("feature_sum")
    )


@query("candidate_labels")
def q_candidate_labels(f: Fixtures):
    cands = retrieve.topk_unseen(f.vu, f.vi, f.e_train, K, "dot", digits=DIGITS)
    return masks.candidate_labels(cands.select(USER, ITEM, "rank"), f.e_test)


@query("candidate_labels_union")
def q_candidate_labels_union(f: Fixtures):
    # the union formulation: test rows and bare candidate pairs unioned (missing rating = null),
    # candidate pairs kept, one row per pair with rated rows first; equals candidate_labels
    cands = retrieve.topk_unseen(f.vu, f.vi, f.e_train, K, "dot", digits=DIGITS).select(USER, ITEM)
    rows = masks.with_missing_as_null(_pairs(f.e_test).withColumn("_prio", F.lit(0)), cands.withColumn("_prio", F.lit(1)))
    return masks.first_per_pair(masks.in_pairs(rows, cands), "_prio").select(USER, ITEM, RATING)


@query("rerank_topk")
def q_rerank_topk(f: Fixtures):
    # candidates: 3k nearest unseen items; re-ranked by dot product, best k kept
    cands = retrieve.topk_unseen(f.vu, f.vi_scaled, f.e_train, 3 * K, "euclidean", digits=DIGITS).select(USER, ITEM)
    uf = f.vu.select(F.col("id").alias(USER), F.col("features").alias("_uf"))
    itf = f.vi.select(F.col("id").alias(ITEM), F.col("features").alias("_if"))
    rescored = cands.join(uf, USER).join(itf, ITEM).withColumn(SCORE, F.round(dot("_uf", "_if"), DIGITS))
    return metrics.topk_set(rescored, K)


# ---- metrics -------------------------------------------------------------------------------
@query("topk_actual")
def q_topk_actual(f: Fixtures):
    return metrics.topk_set(f.e_test, K_RECALL, RATING)


@query("topk_pred")
def q_topk_pred(f: Fixtures):
    return metrics.topk_set(f.dot_lists(K_RECALL), K_RECALL)


@query("recall_per_user")
def q_recall_per_user(f: Fixtures):
    return _round(metrics.recall_per_user(f.e_test, f.dot_lists(K_RECALL), K_RECALL), "recall")


@query("recall_mean")
def q_recall_mean(f: Fixtures):
    return _round(metrics.recall_mean(f.e_test, f.dot_lists(K), K), "recall")


@query("recall_loose")
def q_recall_loose(f: Fixtures):
    return _round(metrics.recall_loose(f.e_test, f.dot_lists(20), 50, 20), "recall")


@query("recall_by_group")
def q_recall_by_group(f: Fixtures):
    grouped = profile.groups(f.e_train, USER, E_TRAIN_USER_BOUNDS)
    return metrics.recall_by_group(f.e_test, f.dot_lists(K_RECALL), grouped, K_RECALL)


@query("coverage_user")
def q_coverage_user(f: Fixtures):
    return _round(metrics.coverage(f.e_test, f.dot_lists(K), K, 1, "user"), "coverage")


@query("coverage_item")
def q_coverage_item(f: Fixtures):
    return _round(metrics.coverage(f.e_test, f.dot_lists(K), K, 3, "item"), "coverage")


@query("coverage_catalog")
def q_coverage_catalog(f: Fixtures):
    return _round(metrics.coverage(f.e_test, f.dot_lists(K), K, 1, "catalog"), "coverage")


@query("error_metrics")
def q_error_metrics(f: Fixtures):
    return _round(metrics.error_metrics(f.e_test, bias.bias_score_pairs(f.e_train, f.e_test)), "mae", "mse", "rmse")


@query("dcg")
def q_dcg(f: Fixtures):
    return _round(metrics.dcg_of_ranks(f.e_test, f.dot_ranks()), "dcg")


@query("ndcg")
def q_ndcg(f: Fixtures):
    return _round(metrics.ndcg_of_ranks(f.e_test, f.dot_ranks()), "ndcg")


@query("ndcg_p")
def q_ndcg_p(f: Fixtures):
    ranks = metrics.ranks_of_vectors(f.p_test, f.vu_p, f.vi_p, f.p_train, "dot", DIGITS)
    return _round(metrics.ndcg_of_ranks(f.p_test, ranks), "ndcg")


@query("target_ranks_p")
def q_target_ranks_p(f: Fixtures):
    return metrics.ranks_of_vectors(f.p_test, f.vu_p, f.vi_p, f.p_train, "dot", DIGITS)


@query("ndcg_topk_list")
def q_ndcg_topk_list(f: Fixtures):
    return _round(metrics.ndcg(f.e_test, metrics.ranks_as_scores(f.knn_recs())), "ndcg")


@query("model_comparison")
def q_model_comparison(f: Fixtures):
    cat_pos = cut_lineage(metrics.catalogue_positions(f.e_test))  # shared by the three evaluations
    grouped = profile.groups(f.e_train, USER, E_TRAIN_USER_BOUNDS)
    parts = [
        metrics.evaluate_ranks(f.e_test, f.bias_ranks(cat_pos), "bias", K, 1, grouped),
        metrics.evaluate_ranks(f.e_test, f.dot_ranks(cat_pos), "dot", K, 1, grouped),
        metrics.evaluate(f.e_test, metrics.ranks_as_scores(f.knn_recs()), "knn", K, 1, cat_pos, grouped),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _round(out, "value")


def _round(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), DIGITS))
    return df


def registry() -> dict[str, Q]:
    from tastemap.plans import model_queries  # noqa: F401  (registers model / tuning queries)

    return dict(_REGISTRY)
