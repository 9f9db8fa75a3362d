"""Bias baseline: score(u, i) = mean rating of item i + mean rating of user u."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.ranking import rank_within
from tastemap.operators.masks import unseen
from tastemap.operators.retrieve import score_users
from tastemap.schema import ITEM, RATING, SCORE, USER
from tastemap.session import materialize

# Ranked item lists up to this many rows are broadcast (after counting them).
MAX_BROADCAST_ITEMS = 1_000_000
# Longer ones are looked up in blocks of so many positions; each copy of a block serves so many rows.
BLOCK = 256
ROWS_PER_COPY = 100_000


def bias_fit(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(user_id, user_mean), (item_id, item_mean); null ratings are skipped."""
    um = train.groupBy(USER).agg(F.avg(RATING).alias("user_mean"))
    im = train.groupBy(ITEM).agg(F.avg(RATING).alias("item_mean"))
    return um, im


def bias_score_pairs(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Scores for given (user, item) pairs; pairs rated in train or with an unknown user or item
    are dropped."""
    um, im = bias_fit(train)
    p = unseen(pairs.select(USER, ITEM), train)
    return p.join(um, USER).join(im, ITEM).select(USER, ITEM, (F.col("item_mean") + F.col("user_mean")).alias(SCORE))


def bias_vectors(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(users, items) as ``id, features``: the bias score is the rank-2 dot product
    [1, user_mean] . [item_mean, 1]."""
    um, im = bias_fit(train)
    users = um.select(F.col(USER).alias("id"), F.array(F.lit(1.0), F.col("user_mean")).alias("features"))
    return users, im.select(F.col(ITEM).alias("id"), F.array(F.col("item_mean"), F.lit(1.0)).alias("features"))


def bias_scores(train: DataFrame) -> DataFrame:
    """All unseen (user, item) scores over train users and items, by the block scorer."""
    return score_users(*bias_vectors(train), "dot", seen=train)


def bias_topk(train: DataFrame, k: int, max_broadcast_items: int = MAX_BROADCAST_ITEMS, block: int = BLOCK, rows_per_copy: int = ROWS_PER_COPY) -> DataFrame:
    """Top-k unseen items per user under the bias model, without scoring all pairs.

    The user mean is constant within a user, so every user ranks items in the one global
    item-mean order, and wants its first k positions but for the seen ones. With the seen positions
    s_1 < s_2 < ... the j-th of them comes before the k-th unseen position exactly if s_j - j < k;
    if m do, the list is 1..k + m without them: k rows per user, whatever the user has seen.

    Positions are looked up in blocks of the ranked list. Up to ``max_broadcast_items`` positions in
    use are broadcast. Above that, (user, block) rows are joined to the blocks on the block's number;
    the first blocks carry every user, so a block that n rows need is copied n / ``rows_per_copy``
    times and the rows are dealt over its copies.
    """
    um, im = bias_fit(train)
    ranked = rank_within(im.withColumn("_all", F.lit(0)), "_all", [F.col("item_mean").desc(), F.col(ITEM)], rank_col="pos", max_group_rows=0)
    ranked = materialize(ranked.select("pos", ITEM, "item_mean"), "ranked")
    n_items = ranked.count()
    # AQE splits a popular item's ratings; the ranked side has one row per item
    seen = train.select(USER, ITEM).distinct().join(ranked.select(ITEM, "pos"), ITEM).select(USER, "pos")
    early = rank_within(seen, USER, ["pos"], rank_col="j").filter(F.col("pos") - F.col("j") < k)
    gaps = early.groupBy(USER).agg(F.collect_list("pos").alias("gaps"), F.count(F.lit(1)).alias("m"))
    wanted = um.join(gaps, USER, "left").withColumn("m", F.coalesce("m", F.lit(0)))
    last = F.least(F.lit(k) + F.col("m"), F.lit(n_items)).cast("long")
    free = F.array_except(F.sequence(F.lit(1).cast("long"), last), F.coalesce("gaps", F.array().cast("array<bigint>")))
    wanted = wanted.filter(last > 0).select(USER, "user_mean", F.posexplode(free).alias("rank", "pos")).withColumn("rank", (F.col("rank") + 1).cast("long"))
    score = (F.col("item_mean") + F.col("user_mean")).alias(SCORE)
    if n_items <= max_broadcast_items:
        return wanted.join(F.broadcast(ranked), "pos").select(USER, ITEM, score, "rank")
    number = F.floor((F.col("pos") - 1) / block)
    asked = materialize(wanted.withColumn("b", number).groupBy(USER, "user_mean", "b").agg(F.collect_list(F.struct("rank", "pos")).alias("asked")), "asked")
    copies = asked.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / rows_per_copy).cast("int").alias("copies"))
    blocks = ranked.withColumn("b", number).groupBy("b").agg(F.map_from_entries(F.collect_list(F.struct("pos", F.struct(ITEM, "item_mean")))).alias("items"))
    blocks = blocks.join(copies, "b").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    dealt = asked.join(F.broadcast(copies), "b").withColumn("copy", F.pmod(F.xxhash64(USER), F.col("copies")).cast("int"))
    met = dealt.select(USER, "user_mean", "b", "copy", "asked").join(blocks.select("b", "copy", "items").hint("shuffle_hash"), ["b", "copy"])
    found = met.select(USER, "user_mean", F.explode(F.transform("asked", lambda a: F.struct(a["rank"].alias("rank"), F.element_at("items", a["pos"]).alias("i")))).alias("f"))
    return found.select(USER, F.col(f"f.i.{ITEM}").alias(ITEM), (F.col("f.i.item_mean") + F.col("user_mean")).alias(SCORE), F.col("f.rank").alias("rank"))
