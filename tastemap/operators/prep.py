"""Deduplication, sampling and splitting of interaction tables."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.functions.ranking import MAX_GROUP_ROWS, rank_within
from tastemap.schema import ITEM, TS, USER
from tastemap.session import checked_broadcast, require_population
from tastemap.session import materialize as materialize_table


def dedupe_latest(df: DataFrame, order: Sequence[str], key: Sequence[str] = (USER, ITEM)) -> DataFrame:
    """Keep the newest row per key by ``order`` (lexicographic, largest wins).

    Written as an aggregate (max of a struct led by the order columns), so it is combined
    map-side: a key holding a third of all rows is reduced before the shuffle.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in list(order) + rest])).alias("_m")
    return df.groupBy(*key).agg(packed).select(*key, *[F.col(f"_m.{c}").alias(c) for c in list(order) + rest]).select(
        *df.columns
    )


def count_by(df: DataFrame, by: str, name: str = "n_ratings") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def active_ids(df: DataFrame, by: str, thresh: int) -> DataFrame:
    """Ids with strictly more than ``thresh`` rows (having-filter)."""
    return count_by(df, by).filter(F.col("n_ratings") > thresh).select(by)


def draw_key(id_col: str | Column, seed: int) -> Column:
    """Seeded draw order: md5 of '<id>#<seed>'. Engine- and partitioning-independent."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f"#{seed}")))


# A draw's cut is narrowed by so many hex digits a pass, until at most so many ids are left in doubt.
DRAW_DIGITS = 3
DRAW_EXACT = 4_096


def draw_ids(ids: DataFrame, id_col: str, n: int, seed: int = 0, what: str = "ids", digits: int = DRAW_DIGITS, exact: int = DRAW_EXACT) -> DataFrame:
    """n ids without replacement in seeded hash order; raises if fewer than n exist.

    A threshold on the hash, found without sorting the ids: a map-side-combined histogram of the
    hash's first ``digits`` hex digits (16^digits bins) shows in which bin the n-th id falls; that bin is
    divided further until it holds at most ``exact`` ids, which give the cut itself. The draw is then a
    filter that every partition applies alone, whatever n is. Ids and hashes are written once, so the
    few passes do not rerun the caller's plan.
    """
    keyed = materialize_table(ids.select(id_col, draw_key(id_col, seed).alias("_h")), "draw")
    if n <= 0:
        return keyed.select(id_col).limit(0)
    prefix, before, total, length = "", 0, None, 0
    while True:
        inside = keyed.filter(F.col("_h").startswith(prefix)) if prefix else keyed
        length = min(32, len(prefix) + digits)
        bins = sorted(inside.groupBy(F.substring("_h", 1, length).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        if total is None:
            total = sum(r["n"] for r in bins)
            require_population(total, n, what)
        for r in bins:
            if before + r["n"] >= n:
                break
            before += r["n"]
        prefix = r["b"]
        if before + r["n"] == n:  # the whole bin is drawn
            return keyed.filter(F.substring("_h", 1, length) <= prefix).select(id_col)
        if r["n"] <= exact or length == 32:
            break
    edge = keyed.filter(F.col("_h").startswith(prefix)).select("_h", id_col).orderBy("_h", id_col).limit(n - before).collect()[-1]
    return keyed.filter(F.struct("_h", id_col) <= F.struct(F.lit(edge["_h"]), F.lit(edge[id_col]).cast(keyed.schema[id_col].dataType))).select(id_col)


MAX_BROADCAST_IDS = 1_000_000


def keep_ids(df: DataFrame, ids: DataFrame, col: str, bounded: bool = False) -> DataFrame:
    """Rows whose ``col`` is in ``ids`` (semi-join). ``bounded`` ids (a drawn sample) are broadcast
    when a count finds at most ``MAX_BROADCAST_IDS``."""
    right = checked_broadcast(ids.select(col), MAX_BROADCAST_IDS, "ids") if bounded else ids.select(col)
    return df.join(right, col, "left_semi")


def sample_rsmr(
    df: DataFrame,
    user_thresh: int = 20,
    item_thresh: int = 500,
    user_sample_n: int = 20000,
    item_sample_n: int = 1000,
    seed: int = 0,
) -> DataFrame:
    """Random sampling after minimum requirement: items with > item_thresh rows, draw
    item_sample_n of them; then, within those items, users with > user_thresh rows, draw
    user_sample_n of them."""
    items = draw_ids(active_ids(df, ITEM, item_thresh), ITEM, item_sample_n, seed, "items")
    by_items = keep_ids(df, items, ITEM, bounded=True)
    users = draw_ids(active_ids(by_items, USER, user_thresh), USER, user_sample_n, seed, "users")
    return keep_ids(by_items, users, USER, bounded=True)


def sample_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct(USER).alias("n_users"),
        F.countDistinct(ITEM).alias("n_items"),
        F.count(F.lit(1)).alias("n_ratings"),
    )


def label_split(
    df: DataFrame, test_size: float = 0.2, order: Sequence[str] = (TS, ITEM), max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Adds ``is_test``: per user, the latest floor(n * test_size) rows in (ts, item) order.

    One total order (ties on ts broken by item), so train and test are disjoint and cover
    the input. Ranks come from :func:`rank_within`, which splits very active users.
    """
    q = Fraction(str(test_size))
    ranked = rank_within(df, USER, list(order), rank_col="_r", count_col="_n", max_group_rows=max_group_rows)
    n_test = F.expr(f"(_n * {q.numerator}) div {q.denominator}")
    return ranked.withColumn("is_test", F.col("_r") > F.col("_n") - n_test).drop("_r", "_n")


def split_by_time(
    df: DataFrame,
    test_size: float = 0.2,
    order: Sequence[str] = (TS, ITEM),
    materialize: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): oldest ceil(n·(1−f)) rows of each user for training, latest floor(n·f) for test.

    The labelled split is written once to the shared checkpoint folder (``materialize``), so the
    many plans that read train and test do not each rescan and re-rank the input.
    """
    if materialize:
        # the hot-key count and the ranking both read the input: keep it on disk between the two
        # jobs instead of recomputing it (a second full shuffle of a deduplicated input)
        kept = df.persist(StorageLevel.DISK_ONLY)
        labelled = materialize_table(label_split(kept, test_size, order, max_group_rows), "split")
        kept.unpersist()
    else:
        labelled = label_split(df, test_size, order, max_group_rows)
    return labelled.filter(~F.col("is_test")).drop("is_test"), labelled.filter("is_test").drop("is_test")


def holdout_flag(df: DataFrame, frac: float = 0.1, seed: int = 0, key: Sequence[str] = (USER, ITEM)) -> Column:
    """True for a deterministic ``frac`` of rows by md5 of the key: the leading 8 hex digits
    at or above (1 − frac)·16⁸."""
    bound = format(int((1 - Fraction(str(frac))) * 16**8), "08x")
    h = F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))
    return F.substring(h, 1, 8) >= F.lit(bound)


def split_holdout(df: DataFrame, frac: float = 0.1, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    flag = holdout_flag(df, frac, seed)
    return df.filter(~flag), df.filter(flag)
