"""Tag vectors and re-ranker feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.schema import ITEM, USER


def item_tag_vectors(tags: DataFrame) -> DataFrame:
    """item_id, tag_vec: relevances ordered by tag_id. A group holds one item's tags (bounded by
    the tag vocabulary)."""
    packed = F.array_sort(F.collect_list(F.struct(F.col("tag_id"), F.col("relevance").cast("double").alias("r"))))
    return tags.groupBy(ITEM).agg(packed.alias("_t")).select(ITEM, F.transform("_t", lambda x: x["r"]).alias("tag_vec"))


def _as_double(c: str):
    return F.transform(F.col(c), lambda x: x.cast("double"))


def nn_features(
    rows: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    tag_vecs: DataFrame | None = None,
    missing_tags: str = "zero",
) -> DataFrame:
    """Rows (user, item, ...) with ``features`` = user factors ++ item factors (++ tag vector).

    Factors are ``id, features``. Rows whose user or item has no factors are dropped.
    ``missing_tags``: ``"zero"`` gives items without tags a zero vector, ``"inner"`` drops their rows.
    """
    uf = user_factors.select(F.col("id").alias(USER), _as_double("features").alias("_uf"))
    itf = item_factors.select(F.col("id").alias(ITEM), _as_double("features").alias("_if"))
    out = rows.join(uf, USER).join(itf, ITEM)
    parts = [F.col("_uf"), F.col("_if")]
    drop = ["_uf", "_if"]
    if tag_vecs is not None:
        tv = tag_vecs.select(ITEM, F.col("tag_vec").alias("_tv"))
        out, vec = _with_tags(out, tv, tag_vecs, ITEM, missing_tags)
        parts.append(vec)
        drop.append("_tv")
    return out.withColumn("features", F.concat(*parts)).drop(*drop)


def _with_tags(rows: DataFrame, tv: DataFrame, tag_vecs: DataFrame, key: str, missing_tags: str):
    """(rows joined with ``_tv``, the tag vector column) under the missing-tag policy."""
    if missing_tags == "inner":
        return rows.join(tv, key), F.col("_tv")
    if missing_tags != "zero":
        raise ValueError(f"unknown missing_tags {missing_tags!r}")
    dim = tag_vecs.agg(F.max(F.size("tag_vec"))).first()[0] or 0
    return rows.join(tv, key, "left"), F.coalesce(F.col("_tv"), F.array_repeat(F.lit(0.0), dim))


def item_side_features(item_factors: DataFrame, tag_vecs: DataFrame | None = None, missing_tags: str = "zero") -> DataFrame:
    """Per-item re-ranker features ``id, features`` = item factors (++ tag vector). Items without
    tags get a zero vector, so no rating and no candidate is lost; ``"inner"`` drops them."""
    itf = item_factors.select(F.col("id"), _as_double("features").alias("f"))
    if tag_vecs is None:
        return itf.withColumnRenamed("f", "features")
    tv = tag_vecs.select(F.col(ITEM).alias("id"), F.col("tag_vec").alias("_tv"))
    out, vec = _with_tags(itf, tv, tag_vecs, "id", missing_tags)
    return out.select("id", F.concat("f", vec).alias("features"))


def user_side_rows(rows: DataFrame, user_factors: DataFrame) -> DataFrame:
    """Rows (user, item, ...) with ``features`` = the user's factors (rows of unknown users dropped)."""
    uf = user_factors.select(F.col("id").alias(USER), _as_double("features").alias("features"))
    return rows.join(uf, USER)
