import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, SF01, interactions
from tastemap.functions.ranking import rank_within
from tastemap.operators import prep
from tastemap.sources import fixtures as fx


def test_dedupe_latest_keeps_newest(spark):
    df = spark.createDataFrame(
        [(1, 10, 1.0, 5, 1), (1, 10, 2.0, 7, 0), (1, 10, 3.0, 7, 2), (2, 10, 4.0, 1, 0)],
        "user_id int, item_id int, rating double, ts long, ev long",
    )
    out = {(r.user_id, r.item_id): r.rating for r in prep.dedupe_latest(df, ["ts", "ev"]).collect()}
    assert out == {(1, 10): 3.0, (2, 10): 4.0}


def test_tie_split_one_total_order(spark):
    # one user, five rows with equal ts: test is the last floor(5*0.2)=1 row in item order
    df = interactions(spark, [(1, i, 1.0, 100) for i in (5, 3, 9, 1, 7)])
    train, test = prep.split_by_time(df)
    assert sorted(r.item_id for r in train.collect()) == [1, 3, 5, 7]
    assert [r.item_id for r in test.collect()] == [9]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_split_properties(spark, sf):
    e = fx.orders_interactions(spark, sf)
    train, test = prep.split_by_time(e)
    key = ["user_id", "item_id"]
    assert train.join(test, key).count() == 0
    assert train.count() + test.count() == e.count()
    n = e.groupBy("user_id").count().withColumnRenamed("count", "n")
    t = test.groupBy("user_id").count().withColumnRenamed("count", "t")
    bad = n.join(t, "user_id", "left").filter(F.coalesce("t", F.lit(0)) != F.floor(F.col("n") / 5))
    assert bad.count() == 0
    # test rows are the latest ones
    last_train = train.groupBy("user_id").agg(F.max(F.struct("ts", "item_id")).alias("m"))
    first_test = test.groupBy("user_id").agg(F.min(F.struct("ts", "item_id")).alias("m2"))
    assert last_train.join(first_test, "user_id").filter(F.col("m") >= F.col("m2")).count() == 0


def test_rank_within_matches_window_with_hot_key(spark):
    rnd = random.Random(1)
    rows = [(0, i, rnd.randint(0, 50)) for i in range(3000)]  # hot key: most rows
    rows += [(k, i, rnd.randint(0, 50)) for k in range(1, 40) for i in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "k int, i int, t int")
    got = rank_within(df, "k", ["t", "i"], rank_col="r", count_col="n", num_partitions=7, max_group_rows=100)
    want = df.withColumn("r2", F.row_number().over(Window.partitionBy("k").orderBy("t", "i"))).withColumn(
        "n2", F.count(F.lit(1)).over(Window.partitionBy("k"))
    )
    j = got.join(want, ["k", "i", "t"])
    assert j.count() == len(rows)
    assert j.filter((F.col("r") != F.col("r2")) | (F.col("n") != F.col("n2"))).count() == 0
    # with no key above the bound the plain window is used and agrees too
    plain = rank_within(df, "k", ["t", "i"], rank_col="r", count_col="n")
    assert plain.join(want, ["k", "i", "t"]).filter((F.col("r") != F.col("r2")) | (F.col("n") != F.col("n2"))).count() == 0


def test_sample_population_too_small(spark):
    p = fx.orders_interactions(spark, SF001)
    with pytest.raises(ValueError, match="cannot draw"):
        prep.sample_rsmr(p, item_thresh=30, item_sample_n=50, user_thresh=5, user_sample_n=50)


def test_sample_rsmr_small_scale(spark):
    p = fx.orders_interactions(spark, SF001)
    s = prep.sample_rsmr(p, item_thresh=25, item_sample_n=50, user_thresh=5, user_sample_n=50)
    tot = prep.sample_totals(s).first()
    assert tot.n_items <= 50 and tot.n_users == 50
    # same seed, same draw; another seed, another draw
    s2 = prep.sample_rsmr(p, item_thresh=25, item_sample_n=50, user_thresh=5, user_sample_n=50)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, s2.collect()))


def test_holdout_fraction(spark):
    e = fx.orders_interactions(spark, SF01)
    fit, held = prep.split_holdout(e, 0.1, seed=0)
    n, h = e.count(), held.count()
    assert fit.count() + h == n
    assert 0.08 < h / n < 0.12


def test_split_hot_user_path_matches_plain(spark):
    # users with more than 20 rows take the range-split path; the split must not change
    p = fx.orders_interactions(spark, SF001)
    key = ["user_id", "item_id"]
    plain = prep.split_by_time(p, materialize=False)
    hot = prep.split_by_time(p, materialize=False, max_group_rows=20)
    for a, b in zip(plain, hot):
        assert a.count() == b.count() and a.join(b, key, "left_anti").count() == 0


@pytest.mark.parametrize("digits, exact", [(3, 4096), (1, 1), (2, 5), (32, 1)])
def test_draw_is_the_smallest_hashes_whatever_the_passes(spark, digits, exact):
    ids = spark.range(3000).withColumnRenamed("id", "x").repartition(7)
    want = sorted(r.x for r in ids.orderBy(prep.draw_key("x", 3), "x").limit(777).collect())
    got = prep.draw_ids(ids, "x", 777, seed=3, digits=digits, exact=exact)
    assert sorted(r.x for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan and "Limit" not in plan


def test_draw_of_all_none_and_too_many(spark):
    ids = spark.range(50).withColumnRenamed("id", "x")
    assert prep.draw_ids(ids, "x", 50).count() == 50
    assert prep.draw_ids(ids, "x", 0).count() == 0
    with pytest.raises(ValueError, match="only 50"):
        prep.draw_ids(ids, "x", 51)


def test_user_threshold_at_work(spark):
    rows = [(u, i, 1.0, 0) for u in range(40) for i in range(10) if u % 4 or i == 0]  # every fourth user has one rating
    got = prep.sample_rsmr(interactions(spark, rows), user_thresh=1, item_thresh=5, user_sample_n=30, item_sample_n=10, seed=1)
    assert {r.user_id for r in got.collect()} == {u for u in range(40) if u % 4}


def test_registered_sample_of_users_with_one_rating(spark):
    # the larger the tables, the fewer users have two of the drawn items: users with one count, too
    from tastemap.plans.queries import SAMPLE_PARAMS

    rows = [(i * 30 + u, i, 1.0, 0) for i in range(60) for u in range(30)]
    total = prep.sample_totals(prep.sample_rsmr(interactions(spark, rows), **SAMPLE_PARAMS)).first()
    assert total.n_users == 50 and total.n_ratings == 50
