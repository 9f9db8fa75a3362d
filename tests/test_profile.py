from pyspark.sql import functions as F

from conftest import interactions
from tastemap.functions.buckets import bucket_id, bucket_label
from tastemap.operators import profile


def test_bounds_micro_fixture(spark):
    counts = [5, 6, 10, 11, 50, 51, 100000, 100001]
    df = spark.createDataFrame([(c,) for c in counts], "n long")
    out = df.select("n", bucket_id(F.col("n")).alias("g"), bucket_label(F.col("n")).alias("l")).orderBy("n").collect()
    assert [r.g for r in out] == [1, 2, 2, 3, 3, 4, 8, 9]
    assert [r.l for r in out] == ["0-5", "5-10", "5-10", "10-50", "10-50", "50-100", "10000-100000", "100000+"]


def test_groups_and_counts(spark):
    df = interactions(spark, [(1, i, 1.0, i) for i in range(7)] + [(2, 1, 1.0, 1)])
    g = {r.user_id: (r.n_ratings, r.group_id, r.group_range) for r in profile.groups(df, "user_id").collect()}
    assert g == {1: (7, 2, "5-10"), 2: (1, 1, "0-5")}
    c = {r.group_id: r.n_members for r in profile.group_counts(profile.groups(df, "user_id")).collect()}
    assert c == {1: 1, 2: 1}


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(x,) for x in [0, 1, 2, 10]], "v long")
    h = {r.bin: r.n for r in profile.histogram(df, "v", 5).collect()}
    assert h == {0: 2, 1: 1, 4: 1}


def test_id_dictionary_positions(spark):
    df = interactions(spark, [(u, 1, 1.0, 0) for u in (30, 10, 20, 10)])
    d = {r.user_id: r.pos for r in profile.id_dictionary(df, "user_id").collect()}
    assert d == {10: 0, 20: 1, 30: 2}


def test_pivot_user_blocks_holds_every_rating(spark):
    cells = [(u, i, float(u + i), 0) for u in range(0, 700, 7) for i in (1, 2) if (u + i) % 3]
    rows = profile.pivot_user_blocks(interactions(spark, cells), 30).collect()
    assert sorted((u, r.item_id, x) for r in rows for u, x in zip(r.users, r.ratings, strict=True)) == sorted(c[:3] for c in cells)
    assert all(u // 7 // 30 == r.block for r in rows for u in r.users) and max(len(r.users) for r in rows) <= 30
    assert len({(r.item_id, r.block) for r in rows}) == len(rows)
