"""Ranking and error metrics in long form.

Population (by key, not by matrix position): test users and the test catalogue (distinct
test items). Predictions are restricted to that population before ranking. A user's top-k
is ``row_number() over (partition by user order by score desc, item) <= k``; users with
fewer than k scored items keep all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.functions.ranking import top_k
from tastemap.operators import retrieve
from tastemap.operators.masks import PAIR, catalogue
from tastemap.operators.prep import count_by
from tastemap.operators.profile import histogram, id_dictionary
from tastemap.schema import ITEM, RATING, SCORE, USER
from tastemap.session import cut_lineage, materialize


def population(scores: DataFrame, test: DataFrame) -> DataFrame:
    """Predictions for test users on test-catalogue items."""
    return scores.join(catalogue(test), ITEM, "left_semi").join(test.select(USER).distinct(), USER, "left_semi")


def topk_set(scored: DataFrame, k: int, score_col: str = SCORE) -> DataFrame:
    """The k best items per user (score desc, item asc): user_id, item_id, rank."""
    return top_k(scored, USER, [F.col(score_col).desc(), F.col(ITEM)], k).select(USER, ITEM, "rank")


def hits(test: DataFrame, scores: DataFrame, k_truth: int, k_pred: int) -> DataFrame:
    """Pairs in both the user's top-k_truth test items and top-k_pred predictions."""
    actual = topk_set(test, k_truth, RATING)
    pred = topk_set(population(scores, test), k_pred)
    return actual.select(*PAIR).join(pred.select(*PAIR), PAIR)


def recall_per_user(test: DataFrame, scores: DataFrame, k: int = 5, k_truth: int | None = None, k_pred: int | None = None) -> DataFrame:
    """user_id, hits, n_test, recall = hits / min(k_pred, n_test). Users without hits count 0.

    ``k_truth``/``k_pred`` give the loose variant (different list lengths on each side)."""
    kt, kp = k_truth or k, k_pred or k
    h = hits(test, scores, kt, kp).groupBy(USER).agg(F.count(F.lit(1)).alias("hits"))
    n = count_by(test, USER, "n_test")
    out = n.join(h, USER, "left").withColumn("hits", F.coalesce(F.col("hits"), F.lit(0)).cast("long"))
    return out.select(USER, "hits", "n_test", (F.col("hits") / F.least(F.lit(kp), F.col("n_test"))).alias("recall"))


def recall_mean(test: DataFrame, scores: DataFrame, k: int = 5) -> DataFrame:
    return recall_per_user(test, scores, k).agg(F.avg("recall").alias("recall"))


def recall_loose(test: DataFrame, scores: DataFrame, k_truth: int = 50, k_pred: int = 20) -> DataFrame:
    """Loose recall: top-``k_truth`` test items against top-``k_pred`` predictions, over
    min(k_pred, n_test). (The published helper names these the other way round.)"""
    return recall_per_user(test, scores, k_truth=k_truth, k_pred=k_pred).agg(F.avg("recall").alias("recall"))


def recall_by_group(test: DataFrame, scores: DataFrame, grouped: DataFrame, k: int = 5) -> DataFrame:
    """Mean recall per user bucket (buckets from ``grouped`` = :func:`groups` on train), 4 places."""
    r = recall_per_user(test, scores, k).join(grouped.select(USER, "group_id", "group_range"), USER)
    return r.groupBy("group_id", "group_range").agg(F.round(F.avg("recall"), 4).alias("recall"), F.count(F.lit(1)).alias("n_users"))


def recall_histogram(test: DataFrame, scores: DataFrame, k: int = 5, bins: int = 10) -> DataFrame:
    return histogram(recall_per_user(test, scores, k), "recall", bins)


def coverage(test: DataFrame, scores: DataFrame, k: int = 10, threshold: int = 3, kind: str = "user") -> DataFrame:
    """Share of test users (``user``) with >= threshold hits, or of catalogue items (``item``)
    hit for >= threshold users; ``catalog`` is item coverage at threshold 1."""
    if kind not in ("user", "item", "catalog"):
        raise ValueError(f"unknown coverage type {kind!r}")
    h = hits(test, scores, k, k)
    if kind == "user":
        per = h.groupBy(USER).agg(F.count(F.lit(1)).alias("h"))
        base = test.select(USER).distinct().join(per, USER, "left")
        t = threshold
    else:
        per = h.groupBy(ITEM).agg(F.count(F.lit(1)).alias("h"))
        base = catalogue(test).join(per, ITEM, "left")
        t = 1 if kind == "catalog" else threshold
    return base.agg(F.avg(F.when(F.coalesce(F.col("h"), F.lit(0)) >= t, 1.0).otherwise(0.0)).alias("coverage"))


def error_metrics(test: DataFrame, scores: DataFrame) -> DataFrame:
    """MAE, MSE, RMSE over pairs present on both sides."""
    j = test.select(*PAIR, RATING).join(scores.select(*PAIR, SCORE), PAIR)
    err = F.col(RATING) - F.col(SCORE)
    return j.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.count(F.lit(1)).alias("n_pairs"),
    )


def _gain(rank_col: str):
    return 1.0 / F.log2(F.col(rank_col).cast("double") + 1.0)


def catalogue_positions(test: DataFrame) -> DataFrame:
    """item_id, pos: 0-based position of each test-catalogue item in id order."""
    return id_dictionary(catalogue(test), ITEM)


def ranks_of_scores(test: DataFrame, scores: DataFrame, cat_pos: DataFrame | None = None) -> DataFrame:
    """The rank of every test pair in its user's order of the whole test catalogue, from a table of scores:
    user_id, item_id, is_scored, r.

    Scored items come first by (score desc, item), then unscored items by item id. A test item that is
    scored takes its window rank; an unscored one takes n_scored(u) + catalogue_pos(i) - #{scored items
    of u below i}. Windows are per user over the scores' rows; scores of factor models need no such
    table (:func:`ranks_of_vectors`).
    """
    t = test.select(*PAIR)
    s = population(scores, test).select(*PAIR, SCORE)
    by_user = Window.partitionBy(USER)
    s_r = s.withColumn("r", F.row_number().over(by_user.orderBy(F.col(SCORE).desc(), F.col(ITEM))).cast("long"))
    scored_t = t.join(s_r.select(*PAIR, "r"), PAIR).select(*PAIR, F.lit(True).alias("is_scored"), "r")
    cat_pos = cat_pos if cat_pos is not None else catalogue_positions(test)
    unscored_t = t.join(s, PAIR, "left_anti").withColumn("listed", F.lit(0))
    merged = unscored_t.unionByName(s.select(*PAIR).withColumn("listed", F.lit(1)))
    below = merged.withColumn(
        "below", F.coalesce(F.sum("listed").over(by_user.orderBy(ITEM).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).filter(F.col("listed") == 0)
    n_scored = s.groupBy(USER).agg(F.count(F.lit(1)).alias("n_scored"))
    unscored_r = (
        below.join(cat_pos, ITEM)
        .join(n_scored, USER, "left")
        .select(*PAIR, F.lit(False).alias("is_scored"), (F.coalesce(F.col("n_scored"), F.lit(0)) + F.col("pos") + 1 - F.col("below")).alias("r"))
    )
    return scored_t.unionByName(unscored_r)


def ranks_of_vectors(
    test: DataFrame, users: DataFrame, items: DataFrame, seen: DataFrame, metric: str = "dot", digits: int | None = None, cat_pos: DataFrame | None = None, **blocks
) -> DataFrame:
    """As :func:`ranks_of_scores`, for scores that are dot products (or distances) of user and item vectors
    (``id, features``): block tasks count the unseen items above each test item, so no more than one row
    per test pair leaves them and no user x item grid exists. Written once, as several metrics read it."""
    u = users.join(test.select(F.col(USER).alias("id")).distinct(), "id", "left_semi")
    i = items.join(catalogue(test).select(F.col(ITEM).alias("id")), "id", "left_semi")
    counts = materialize(retrieve.rank_targets(u, i, test.select(*PAIR), seen, metric, digits, **blocks), "ranks")
    scored = counts.filter("is_scored").select(*PAIR, "is_scored", (F.col("above") + 1).alias("r"))
    unscored = counts.filter(~F.col("is_scored"))
    if unscored.isEmpty():
        return scored
    pos = cat_pos if cat_pos is not None else catalogue_positions(test)
    return scored.unionByName(unscored.join(pos, ITEM).select(*PAIR, "is_scored", (F.col("n_scored") + F.col("pos") + 1 - F.col("below")).alias("r")))


def gains(test: DataFrame, ranks: DataFrame) -> DataFrame:
    """One row: total discounted gain of the ranks (``dcg_sum``), of the ideal order (``ideal_sum``) and the
    catalogue size."""
    zero, no_item = F.lit(0.0), F.lit(None).cast("int")
    ideal = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("n")), zero, lambda a, r: a + 1.0 / F.log2(r.cast("double") + 1.0))
    rows = ranks.select(_gain("r").alias("pred"), zero.alias("ideal"), no_item.alias("item"))
    rows = rows.unionByName(count_by(test, USER, "n").select(zero.alias("pred"), ideal.alias("ideal"), no_item.alias("item")))
    rows = rows.unionByName(catalogue(test).select(zero.alias("pred"), zero.alias("ideal"), F.col(ITEM).alias("item")))
    return rows.agg(F.sum("pred").alias("dcg_sum"), F.sum("ideal").alias("ideal_sum"), F.count("item").alias("n_catalogue"))


def dcg_of_ranks(test: DataFrame, ranks: DataFrame) -> DataFrame:
    """Mean over rank positions of the summed binary gain (total / catalogue size)."""
    return gains(test, ranks).select((F.col("dcg_sum") / F.col("n_catalogue")).alias("dcg"))


def ndcg_of_ranks(test: DataFrame, ranks: DataFrame) -> DataFrame:
    """DCG of the ranks over DCG of the ideal order (ratio of totals, no cutoff)."""
    return gains(test, ranks).select((F.col("dcg_sum") / F.col("ideal_sum")).alias("ndcg"))


def dcg(test: DataFrame, scores: DataFrame) -> DataFrame:
    return dcg_of_ranks(test, ranks_of_scores(test, scores))


def ndcg(test: DataFrame, scores: DataFrame, cat_pos: DataFrame | None = None) -> DataFrame:
    return ndcg_of_ranks(test, ranks_of_scores(test, scores, cat_pos))


def evaluate(
    test: DataFrame,
    scores: DataFrame,
    model: str,
    k: int = 10,
    threshold: int = 1,
    cat_pos: DataFrame | None = None,
    grouped: DataFrame | None = None,
) -> DataFrame:
    """:func:`evaluate_ranks` of a table of scores."""
    return evaluate_ranks(test, cut_lineage(ranks_of_scores(test, scores, cat_pos)), model, k, threshold, grouped)


def evaluate_ranks(test: DataFrame, ranks: DataFrame, model: str, k: int = 10, threshold: int = 1, grouped: DataFrame | None = None) -> DataFrame:
    """The per-model evaluation rows (model, metric, value): mean recall@k, user / item /
    catalog coverage, NDCG, and with ``grouped`` (user_id, group_id) the mean recall of every
    activity bucket as ``recall_group_<id>``. All come from the ranks of the test pairs: a hit is one of the
    user's top-k test items whose rank among the predictions is at most k."""
    best = ranks.filter(F.col("is_scored") & (F.col("r") <= k)).select(*PAIR)
    h = cut_lineage(topk_set(test, k, RATING).select(*PAIR).join(best, PAIR))
    n = count_by(test, USER, "n_test")
    per_user = h.groupBy(USER).agg(F.count(F.lit(1)).alias("h"))
    per_item = h.groupBy(ITEM).agg(F.count(F.lit(1)).alias("h"))
    hh = F.coalesce(F.col("h"), F.lit(0))
    users = n.join(per_user, USER, "left")
    items = catalogue(test).join(per_item, ITEM, "left")
    recall, covered = F.avg(hh / F.least(F.lit(k), F.col("n_test"))), F.avg(F.when(hh >= threshold, 1.0).otherwise(0.0))
    by_name = lambda df, *cs: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in cs])).alias("m")).select("m.*")
    out = by_name(users.agg(recall.alias("recall"), covered.alias("user_coverage")), "recall", "user_coverage")
    out = out.unionByName(
        by_name(items.agg(covered.alias("item_coverage"), F.avg(F.when(hh >= 1, 1.0).otherwise(0.0)).alias("catalog_coverage")), "item_coverage", "catalog_coverage")
    )
    out = out.unionByName(by_name(ndcg_of_ranks(test, ranks), "ndcg"))
    if grouped is not None:
        per = users.join(grouped.select(USER, "group_id"), USER).groupBy("group_id").agg(recall.alias("value"))
        out = out.unionByName(per.select(F.concat(F.lit("recall_group_"), F.col("group_id")).alias("metric"), "value"))
    return out.select(F.lit(model).alias("model"), "metric", "value")


def ranks_as_scores(recs: DataFrame) -> DataFrame:
    """A ranked list (user, item, rank) as scores where rank 1 scores highest."""
    return recs.select(USER, ITEM, (-F.col("rank")).cast("double").alias(SCORE))
