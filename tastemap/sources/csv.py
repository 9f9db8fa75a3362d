"""Scans and sinks of the published CSV layouts with declared schemas (no inference).

A line that does not fit its schema (a missing or surplus field, text in a number column, an id that is
missing) is handled by ``on_corrupt``: ``"fail"`` stops the scan with the line in the error, ``"drop"``
leaves it out, and :func:`read_with_rejects` returns such lines beside the good rows. A null rating,
timestamp or relevance is a value, not an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemap.schema import ITEM, RATING, RATINGS_CSV, TAGS_CSV, TS, USER

CORRUPT = "_corrupt_line"
RATINGS = (RATINGS_CSV, {"userId": USER, "movieId": ITEM, "rating": RATING, "timestamp": TS})
TAGS = (TAGS_CSV, {"movieId": ITEM, "tagId": "tag_id", "relevance": "relevance"})
ID_COLUMNS = ("userId", "movieId", "tagId")


def _scan(spark: SparkSession, path: str | list[str], layout) -> DataFrame:
    """All lines, with ``CORRUPT`` set where a line does not fit."""
    schema = T.StructType([*layout[0].fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    no_id = F.lit(False)
    for c in layout[0].names:
        if c in ID_COLUMNS:
            no_id = no_id | F.col(c).isNull()
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in layout[0].names])
    return rows.withColumn(CORRUPT, F.coalesce(F.col(CORRUPT), F.when(no_id, line)))


def _named(rows: DataFrame, layout) -> DataFrame:
    return rows.select(*[F.col(c).alias(name) for c, name in layout[1].items()])


def _read(spark: SparkSession, path: str | list[str], layout, on_corrupt: str) -> DataFrame:
    if on_corrupt not in ("fail", "drop"):
        raise ValueError(f"unknown on_corrupt {on_corrupt!r}")
    rows = _scan(spark, path, layout)
    if on_corrupt == "drop":
        return _named(rows.filter(F.col(CORRUPT).isNull()), layout)
    stop = F.raise_error(F.concat(F.lit("line does not fit the schema: "), F.col(CORRUPT))).cast("boolean")
    return _named(rows.filter(F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(stop)), layout)


def read_ratings_csv(spark: SparkSession, path: str | list[str], on_corrupt: str = "fail") -> DataFrame:
    """Ratings file with header ``userId,movieId,rating,timestamp`` → user_id, item_id, rating, ts."""
    return _read(spark, path, RATINGS, on_corrupt)


def read_tags_csv(spark: SparkSession, path: str | list[str], on_corrupt: str = "fail") -> DataFrame:
    """Tag relevance file with header ``movieId,tagId,relevance`` → item_id, tag_id, relevance."""
    return _read(spark, path, TAGS, on_corrupt)


def read_with_rejects(spark: SparkSession, path: str | list[str], layout=RATINGS) -> tuple[DataFrame, DataFrame]:
    """(good rows, lines that do not fit)."""
    rows = _scan(spark, path, layout)
    return _named(rows.filter(F.col(CORRUPT).isNull()), layout), rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def _write(df: DataFrame, path: str, layout, mode: str) -> None:
    kinds = {f.name: f.dataType for f in layout[0].fields}
    df.select(*[F.col(name).cast(kinds[c]).alias(c) for c, name in layout[1].items()]).write.mode(mode).option("header", True).csv(path)


def write_ratings_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """user_id, item_id, rating, ts as a folder of files of the ratings layout, one per partition."""
    _write(df, path, RATINGS, mode)


def write_tags_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """item_id, tag_id, relevance as a folder of files of the tags layout, one per partition."""
    _write(df, path, TAGS, mode)
