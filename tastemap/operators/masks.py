"""Key-joined replacements for matrix masking and alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.schema import ITEM, RATING, USER

PAIR = [USER, ITEM]


def unseen(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop pairs already rated (anti-join on user, item)."""
    return pairs.join(seen.select(*PAIR), PAIR, "left_anti")


def in_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Keep rows whose (user, item) is in ``pairs`` (semi-join)."""
    return df.join(pairs.select(*PAIR), PAIR, "left_semi")


def catalogue(test: DataFrame) -> DataFrame:
    """The evaluation catalogue: distinct items of the test set."""
    return test.select(ITEM).distinct()


def align_to_catalogue(scores: DataFrame, test: DataFrame) -> DataFrame:
    """Predictions restricted to the test catalogue (long form needs no filler rows)."""
    return scores.join(catalogue(test), ITEM, "left_semi")


def candidate_labels(candidates: DataFrame, test: DataFrame) -> DataFrame:
    """Each candidate pair with its test rating where one exists (null otherwise)."""
    return candidates.join(test.select(*PAIR, RATING), PAIR, "left")


def with_missing_as_null(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; columns absent on one side become null."""
    return a.unionByName(b, allowMissingColumns=True)


def first_per_pair(df: DataFrame, priority: str) -> DataFrame:
    """One row per pair, the one with the smallest ``priority`` (explicit, order-safe)."""
    packed = F.min(F.struct(F.col(priority), *[F.col(c) for c in df.columns if c not in PAIR and c != priority]))
    rest = [c for c in df.columns if c not in PAIR]
    return df.groupBy(*PAIR).agg(packed.alias("_m")).select(*PAIR, *[F.col(f"_m.{c}").alias(c) for c in rest])
