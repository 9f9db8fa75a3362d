import math
import random

import numpy as np
import pytest

from conftest import interactions, scores
from tastemap.plans import metrics


def _one(df, col):
    return df.first()[col]


def test_short_user_denominator(spark):
    # 3 test items, k = 5: recall = hits / 3
    test = interactions(spark, [(1, 1, 5.0), (1, 2, 4.0), (1, 3, 3.0)], with_ts=False)
    pred = scores(spark, [(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.1)])
    r = metrics.recall_per_user(test, pred, 5).first()
    assert r.hits == 3 and r.recall == 1.0


def test_user_without_predictions_counts_zero(spark):
    test = interactions(spark, [(1, 1, 5.0), (2, 1, 5.0)], with_ts=False)
    pred = scores(spark, [(1, 1, 1.0)])
    assert _one(metrics.recall_mean(test, pred, 5), "recall") == 0.5
    assert _one(metrics.coverage(test, pred, 10, 1, "user"), "coverage") == 0.5


def test_outside_item_ignored(spark):
    test = interactions(spark, [(1, 1, 5.0), (1, 2, 4.0)], with_ts=False)
    pred = scores(spark, [(1, 99, 9.0), (1, 1, 1.0)])  # item 99 is not in the test catalogue
    assert _one(metrics.recall_mean(test, pred, 1), "recall") == 1.0


def test_negative_scores_are_kept(spark):
    test = interactions(spark, [(1, 1, 5.0)], with_ts=False)
    pred = scores(spark, [(1, 1, -3.0)])
    assert _one(metrics.recall_mean(test, pred, 5), "recall") == 1.0


def test_unknown_coverage_type(spark):
    test = interactions(spark, [(1, 1, 5.0)], with_ts=False)
    with pytest.raises(ValueError):
        metrics.coverage(test, scores(spark, [(1, 1, 1.0)]), kind="bogus")


def _dense_ndcg(test_rows, score_rows):
    users = sorted({u for u, _, _ in test_rows})
    cat = sorted({i for _, i, _ in test_rows})
    s = {(u, i): v for u, i, v in score_rows}
    t = {(u, i) for u, i, _ in test_rows}
    dcg = ideal = 0.0
    for u in users:
        scored = sorted([i for i in cat if (u, i) in s], key=lambda i: (-s[(u, i)], i))
        order = scored + [i for i in cat if (u, i) not in s]
        for r, i in enumerate(order, 1):
            if (u, i) in t:
                dcg += 1 / math.log2(r + 1)
        n = sum(1 for i in cat if (u, i) in t)
        ideal += sum(1 / math.log2(r + 1) for r in range(1, n + 1))
    return dcg / ideal, dcg / len(cat)


def test_ndcg_matches_dense_ranking(spark):
    rnd = random.Random(3)
    test_rows = [(u, i, 1.0) for u in range(12) for i in range(25) if rnd.random() < 0.3]
    score_rows = [(u, i, round(rnd.random(), 2)) for u in range(14) for i in range(30) if rnd.random() < 0.5]
    want_ndcg, want_dcg = _dense_ndcg(test_rows, score_rows)
    t, p = interactions(spark, test_rows, with_ts=False), scores(spark, score_rows)
    assert abs(_one(metrics.ndcg(t, p), "ndcg") - want_ndcg) < 1e-12
    assert abs(_one(metrics.dcg(t, p), "dcg") - want_dcg) < 1e-12


def test_metric_properties(spark):
    rnd = random.Random(5)
    test_rows = [(u, i, float(rnd.randint(1, 10)) / 2) for u in range(20) for i in range(30) if rnd.random() < 0.25]
    t = interactions(spark, test_rows, with_ts=False)
    as_scores = t.selectExpr("user_id", "item_id", "rating AS score")
    assert abs(_one(metrics.ndcg(t, as_scores), "ndcg") - 1.0) < 1e-12
    p = scores(spark, [(u, i, rnd.random()) for u in range(20) for i in range(30)])
    vals = [_one(metrics.recall_mean(t, p, 10), "recall")] + [
        _one(metrics.coverage(t, p, 10, 1, k), "coverage") for k in ("user", "item", "catalog")
    ]
    assert all(0.0 <= v <= 1.0 for v in vals)
    assert _one(metrics.coverage(t, p, 10, 1, "item"), "coverage") == _one(metrics.coverage(t, p, 10, 1, "catalog"), "coverage")
    assert _one(metrics.ndcg(t, p), "ndcg") <= 1.0 + 1e-12


def test_error_metrics(spark):
    t = interactions(spark, [(1, 1, 3.0), (1, 2, 4.0), (2, 1, 1.0)], with_ts=False)
    p = scores(spark, [(1, 1, 2.0), (1, 2, 4.0), (3, 3, 1.0)])
    r = metrics.error_metrics(t, p).first()
    assert r.mae == 0.5 and r.mse == 0.5 and np.isclose(r.rmse, math.sqrt(0.5)) and r.n_pairs == 2
