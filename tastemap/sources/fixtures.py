"""Interaction, tag and vector views over the driver's parquet tables.

E: dense interactions from ``events``; P: sparse interactions from ``orders`` joined with
``lineitem``; T: item tag relevances from ``embeddings``; V: fixed user and item vectors
from ``embeddings``. All are lazy plans over the scans, so filters and column pruning reach
the parquet readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.operators.prep import dedupe_latest
from tastemap.schema import ITEM, RATING, TS, USER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: user_id, item_id = props.k, rating from value on a half-star scale, ts; newest row per pair."""
    ev = table(spark, sf_dir, "events")
    rows = ev.select(
        F.col("user_id").cast("int").alias(USER),
        F.get_json_object("props", "$.k").cast("int").alias(ITEM),
        (F.least(F.lit(10), F.floor(F.col("value") / 10) + 1) / 2).alias(RATING),
        F.col("ts").alias(TS),
        F.col("event_id"),
    )
    return dedupe_latest(rows, order=[TS, "event_id"]).drop("event_id")


def orders_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: customer x part from order lines; rating from quantity; newest line per pair."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias(USER),
        F.col("l_partkey").cast("int").alias(ITEM),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias(RATING),
        F.col("l_shipdate").alias(TS),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
    )
    return dedupe_latest(rows, order=[TS, "l_orderkey", "l_linenumber"]).drop("l_orderkey", "l_linenumber")


def item_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: item_id, tag_id (0-based position), relevance."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("int").alias(ITEM), F.posexplode("embedding").alias("tag_id", "relevance")
    ).select(ITEM, F.col("tag_id").cast("int"), F.col("relevance").cast("double"))


# Fixed vector layout: item i has the vector at position i of the embeddings, user u the one at
# u + 100, both modulo the number of embeddings, so every item and user has one.
V_USER_OFFSET = 100


def _vectors_of(spark: SparkSession, sf_dir: str, ids: DataFrame, offset: int) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_v"), "embedding")
    n = emb.count()
    return ids.select("id", F.pmod(F.col("id") + offset, F.lit(n)).alias("_v")).join(emb, "_v")


def fixed_item_vectors(spark: SparkSession, sf_dir: str, rows: DataFrame, scaled: bool = False) -> DataFrame:
    """V item vectors (id, features ARRAY<DOUBLE>) of the items in ``rows``. ``scaled`` multiplies by
    1 + (id % 7) / 4 so that dot-product and Euclidean orders differ."""
    emb = _vectors_of(spark, sf_dir, rows.select(F.col(ITEM).alias("id")).distinct(), 0)
    feats = F.transform("embedding", lambda x: x.cast("double"))
    if scaled:
        factor = 1 + (F.col("id") % 7) / 4
        feats = F.transform("embedding", lambda x: x.cast("double") * factor)
    return emb.select(F.col("id").cast("int").alias("id"), feats.alias("features"))


def fixed_user_vectors(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """V user vectors of the users in ``rows``."""
    emb = _vectors_of(spark, sf_dir, rows.select(F.col(USER).alias("id")).distinct(), V_USER_OFFSET)
    return emb.select(F.col("id").cast("int").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
