"""Profiling aggregates: activity counts, buckets, histograms, matrix shape, id positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.buckets import DEFAULT_BOUNDS, bucket_id, bucket_label, fixed_bin
from tastemap.functions.ranking import rank_within
from tastemap.operators.prep import count_by
from tastemap.schema import ITEM, RATING, USER
from tastemap.session import materialize


def describe(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ratings per user, ratings per item)."""
    return count_by(df, USER), count_by(df, ITEM)


def groups(df: DataFrame, by: str = USER, bounds: Sequence[int] = DEFAULT_BOUNDS) -> DataFrame:
    """Bucket of each user (or item) by its rating count: ``by, n_ratings, group_id, group_range``."""
    n = F.col("n_ratings")
    return count_by(df, by).select(by, n, bucket_id(n, bounds).alias("group_id"), bucket_label(n, bounds).alias("group_range"))


def group_counts(grouped: DataFrame) -> DataFrame:
    """Members per bucket."""
    return grouped.groupBy("group_id", "group_range").agg(F.count(F.lit(1)).alias("n_members"))


def histogram(values: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins between min and max of ``col`` (numpy's rule: the
    maximum falls in the last bin). Empty bins are not listed. Returns bin, lo, hi, count. The values
    are written once: the bounds and the bins read them from there."""
    values = materialize(values.select(col), "histogram")
    stats = values.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = stats["lo"], stats["hi"]
    if lo is None:
        return values.sparkSession.createDataFrame([], "bin long, bin_lo double, bin_hi double, n long")
    width = (float(hi) - float(lo)) / bins if hi != lo else 0.0
    b = fixed_bin(F.col(col), F.lit(lo), F.lit(hi), bins)
    out = values.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return out.select(
        "bin",
        (F.lit(float(lo)) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        "n",
    )


def matrix_shape(df: DataFrame) -> DataFrame:
    """Size of the (item x user) rating matrix without building it."""
    return df.agg(
        F.countDistinct(ITEM).alias("n_items"),
        F.countDistinct(USER).alias("n_users"),
        F.count(F.lit(1)).alias("n_ratings"),
    )


def id_dictionary(df: DataFrame, col: str) -> DataFrame:
    """Distinct ids with their 0-based position in ascending order (the index of a dense
    matrix axis). Positions come from range partitioning, not a single-partition window."""
    ids = df.select(col).distinct().withColumn("_all", F.lit(0))
    ranked = rank_within(ids, "_all", [col], rank_col="pos", max_group_rows=0)  # always range-split
    return ranked.select(col, (F.col("pos") - 1).alias("pos"))


def pivot_users(df: DataFrame, users: Sequence[int]) -> DataFrame:
    """Wide item x user matrix with one column for each of ``users``. The columns are the caller's
    explicit list: a schema cannot depend on the data. Every item keeps its row."""
    return df.groupBy(ITEM).pivot(USER, list(users)).agg(F.first(RATING))


def pivot_user_blocks(df: DataFrame, block_users: int) -> DataFrame:
    """The whole item x user matrix in rows of bounded width: (item, block, users, ratings) for every
    item and block of ``block_users`` positions of the user dictionary that holds a rating."""
    pos = id_dictionary(df, USER).select(USER, F.floor(F.col("pos") / block_users).alias("block"))
    cells = F.sort_array(F.collect_list(F.struct(USER, RATING)))
    rows = df.select(ITEM, USER, RATING).join(pos, USER).groupBy(ITEM, "block").agg(cells.alias("cells"))
    return rows.select(ITEM, "block", F.col(f"cells.{USER}").alias("users"), F.col(f"cells.{RATING}").alias("ratings"))
