"""Ranking building blocks.

``top_k`` is ``row_number() <= k``; Spark plans it as a partial ``WindowGroupLimit`` before the
shuffle, so at most k rows per key and map partition are shuffled whatever the key's size.

``rank_within`` is an exact 1-based row number per key for groups of any size. A plain window
partitioned by the key would put a hot key (say a third of all rows) into one task. Keys above
a row bound are therefore range-partitioned on (key, order...), so such a key spans many
partitions; each piece is numbered locally, and a small table of per-(partition, key) counts
gives each piece its offset. The partition id is fixed by a reliable checkpoint before it is
used in two branches. Keys under the bound take an ordinary window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemap.session import cut_lineage

OrderSpec = Sequence[str | Column]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_k(df: DataFrame, key: str | Sequence[str], order: OrderSpec, k: int, rank_col: str = "rank") -> DataFrame:
    """First k rows per key in ``order`` (a total order: add a tie-breaker), with their rank."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[_col(c) for c in order])
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).filter(F.col(rank_col) <= k)


# Rows per key above which a key is split across tasks (bounds a window task's input).
MAX_GROUP_ROWS = 5_000_000


def rank_within(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    rank_col: str = "rank",
    count_col: str | None = None,
    num_partitions: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact ``row_number() over (partition by key order by order)`` that splits hot keys.

    ``order`` must make the order total within a key. Optionally adds the key's row count as
    ``count_col``. A map-side-combined count finds the keys with more than ``max_group_rows``
    rows (at most rows / max_group_rows of them, so the list is broadcast); the other keys use
    a plain window, the hot keys' rows the range-split path. ``max_group_rows=0`` splits all keys.
    """
    if max_group_rows <= 0:  # the caller's key is one group: no need to look for it
        return _split_rank(df, key, order, rank_col, count_col, num_partitions)
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > max_group_rows).select(key)
    if hot.count() == 0:
        return _plain_rank(df, key, order, rank_col, count_col)
    hot = F.broadcast(cut_lineage(hot))
    cold = _plain_rank(df.join(hot, key, "left_anti"), key, order, rank_col, count_col)
    split = _split_rank(df.join(hot, key, "left_semi"), key, order, rank_col, count_col, num_partitions)
    return cold.unionByName(split)


def _plain_rank(df, key, order, rank_col, count_col):
    out = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(key).orderBy(*[_col(c) for c in order])).cast("long"))
    if count_col:
        out = out.withColumn(count_col, F.count(F.lit(1)).over(Window.partitionBy(key)))
    return out


def _split_rank(df, key, order, rank_col, count_col, num_partitions):
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordc = [_col(c) for c in order]
    ranged = df.repartitionByRange(n, F.col(key), *ordc).withColumn("_pid", F.spark_partition_id())
    # The piece id must be the same in every branch and retry; range bounds come from a sample,
    # so a recomputed exchange could move rows. A reliable checkpoint makes it data.
    ranged = cut_lineage(ranged)
    local = ranged.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid", key).orderBy(*ordc)))
    pieces = local.groupBy("_pid", key).agg(F.max("_lrn").alias("_cnt"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_cnt").over(Window.partitionBy(key)))
    cols = ["_pid", key, "_off"] + ([count_col] if count_col else [])
    out = local.join(offsets.select(*cols), ["_pid", key])
    return out.withColumn(rank_col, (F.col("_lrn") + F.col("_off")).cast("long")).drop("_pid", "_lrn", "_off")
