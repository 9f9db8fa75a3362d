"""Matrix factorisation with Spark ML's ALS (explicit feedback), seeded."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.schema import ITEM, RATING, SCORE, USER
from tastemap.session import checkpoint_dir

INT_MAX = 2**31 - 1


def _check_ids(train: DataFrame) -> None:
    r = train.agg(F.min(USER), F.max(USER), F.min(ITEM), F.max(ITEM)).first()
    if any(v is not None and not (-(2**31) <= v <= INT_MAX) for v in r):
        raise ValueError("ALS needs user and item ids that fit a 32-bit integer")


RATINGS_PER_BLOCK = 2_000_000
MIN_BLOCKS = 10


def blocks_for(train: DataFrame) -> int:
    return max(MIN_BLOCKS, -(-train.count() // RATINGS_PER_BLOCK))


#: Item blocks of a fit that runs beside others, and user blocks for each of them from there on.
MIN_ITEM_BLOCKS = 2
USER_BLOCKS_PER_ITEM_BLOCK = 8


def item_blocks_beside(blocks: int) -> int:
    """Item blocks of a fit with ``blocks`` user blocks that runs beside others. Every iteration sends a user's
    factors once to each item block that holds one of the user's items, which is most of what a fit shuffles;
    fits side by side fill the cores with fewer blocks each. The user blocks set the first factors, so these
    stay, and the item blocks change no result but by the rounding of sums."""
    return max(MIN_ITEM_BLOCKS, -(-blocks // USER_BLOCKS_PER_ITEM_BLOCK))


def fit_als(
    train: DataFrame,
    rank: int = 10,
    max_iter: int = 10,
    reg: float = 0.1,
    seed: int = 0,
    num_blocks: int | None = None,
    check_ids: bool = True,
    beside: bool = False,
) -> ALSModel:
    """Fit explicit ALS on (user_id, item_id, rating). Unknown ids at predict time are dropped.
    ``num_blocks`` (user and item blocks) follows the number of ratings, not the machine, so factors
    are the same on any cluster: one block for each ``RATINGS_PER_BLOCK``, at least ``MIN_BLOCKS``. A fit
    ``beside`` others has fewer item blocks (:func:`item_blocks_beside`)."""
    spark = train.sparkSession
    if check_ids and any(t not in ("int", "smallint", "tinyint") for c, t in train.dtypes if c in (USER, ITEM)):
        _check_ids(train)
    checkpoint_dir(spark)  # ALS cuts its lineage every checkpointInterval iterations
    nb = num_blocks or blocks_for(train)
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg,
        userCol=USER,
        itemCol=ITEM,
        ratingCol=RATING,
        coldStartStrategy="drop",
        seed=seed,
        numUserBlocks=nb,
        numItemBlocks=item_blocks_beside(nb) if beside else nb,
        checkpointInterval=10,
    )
    return als.fit(train.select(F.col(USER).cast("int"), F.col(ITEM).cast("int"), F.col(RATING).cast("float")))


def factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors), each ``id, features ARRAY<FLOAT>``; left distributed."""
    return model.userFactors, model.itemFactors


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """ALS prediction for given pairs (pairs with an unknown user or item are dropped)."""
    out = model.transform(pairs.select(F.col(USER).cast("int"), F.col(ITEM).cast("int"), *[c for c in pairs.columns if c not in (USER, ITEM)]))
    return out.withColumnRenamed("prediction", SCORE).withColumn(SCORE, F.col(SCORE).cast("double"))
