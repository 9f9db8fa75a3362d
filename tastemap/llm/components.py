"""Connected components of an edge table by alternating large and small stars, in DataFrame rounds.

No edge list leaves the executors: a round is two map-side-combined minima and two joins, written
to the shared checkpoint folder; the number of rounds grows with the logarithm of the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.session import materialize


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component) of every id in ``edges`` (u long, v long); ``component`` is the least id reached."""
    now = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(now)
    for _ in range(max_rounds):
        # large star: neighbours above u go to the least of u's neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: u and its neighbours below go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        now = materialize(small.distinct(), "edges")
        after = _signature(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    found = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
