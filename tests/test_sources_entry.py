import pytest

from conftest import SF001
from tastemap.sources.csv import read_ratings_csv, read_tags_csv, read_with_rejects, write_ratings_csv, write_tags_csv


def test_ratings_csv(spark, tmp_path):
    p = tmp_path / "ratings.csv"
    p.write_text("userId,movieId,rating,timestamp\n1,10,4.5,1000\n2,10,3.0,1001\n")
    df = read_ratings_csv(spark, str(p))
    assert df.columns == ["user_id", "item_id", "rating", "ts"]
    assert [tuple(r) for r in df.orderBy("user_id").collect()] == [(1, 10, 4.5, 1000), (2, 10, 3.0, 1001)]


def test_tags_csv(spark, tmp_path):
    p = tmp_path / "genome-scores.csv"
    p.write_text("movieId,tagId,relevance\n10,1,0.25\n10,2,0.5\n")
    df = read_tags_csv(spark, str(p))
    assert df.columns == ["item_id", "tag_id", "relevance"]
    assert df.count() == 2


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    rows = out.collect()
    assert rows and out.columns == ["user_id", "item_id", "score", "rank"]
    assert max(r["rank"] for r in rows) <= 10
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)


BAD = "userId,movieId,rating,timestamp\n1,10,4.5,1000\nx,10,3.0,1001\n2,11,,1002\n3,12,3.5\n,13,1.0,5\n4,14,2.0,7,9\n5,15,0.5,8\n"


def test_lines_that_do_not_fit(spark, tmp_path):
    p = tmp_path / "ratings.csv"
    p.write_text(BAD)
    good = [(1, 10, 4.5, 1000), (2, 11, None, 1002), (5, 15, 0.5, 8)]
    assert sorted(map(tuple, read_ratings_csv(spark, str(p), on_corrupt="drop").collect())) == good
    rows, rejects = read_with_rejects(spark, str(p))
    assert sorted(map(tuple, rows.collect())) == good
    assert sorted(r.line for r in rejects.collect()) == [",13,1.0,5", "3,12,3.5", "4,14,2.0,7,9", "x,10,3.0,1001"]
    with pytest.raises(Exception, match="does not fit the schema"):
        read_ratings_csv(spark, str(p)).collect()
    with pytest.raises(ValueError):
        read_ratings_csv(spark, str(p), on_corrupt="guess")


def test_written_files_are_read_back(spark, tmp_path):
    rows = [(i, i % 7, None if i % 5 == 0 else i / 2, i * 10) for i in range(100)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double, ts long").repartition(3)
    write_ratings_csv(df, str(tmp_path / "r"))
    assert sorted(map(tuple, read_ratings_csv(spark, str(tmp_path / "r")).collect())) == rows
    tags = spark.createDataFrame([(1, 0, 0.25), (1, 1, 1e-9)], "item_id int, tag_id int, relevance double")
    write_tags_csv(tags, str(tmp_path / "t"))
    assert sorted(map(tuple, read_tags_csv(spark, str(tmp_path / "t")).collect())) == [(1, 0, 0.25), (1, 1, 1e-9)]
    empty = df.limit(0)
    write_ratings_csv(empty, str(tmp_path / "e"))
    assert read_ratings_csv(spark, str(tmp_path / "e")).count() == 0
