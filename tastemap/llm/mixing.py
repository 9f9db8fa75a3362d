"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target ``t`` and size ``S`` should be taken ``t / S`` times (at most
twice). The whole part is taken for certain; the fractional parts are rounded together: two
documents trade expected words, up or down by chance with no change in expectation, until one of
them is integral, so the source's expected words are kept exactly at every step. Documents are
paired in size order inside (source, bucket) groups, where buckets are hashes of the document
and their number follows the row count, so a hot source is spread over all buckets. Each group
leaves at most one undecided document; those meet in a reduction tree of fan-in ``FAN_IN`` until
each source has one, which is rounded by itself. A source thus misses its target by less than one
document. Chance comes from hashes of the group, so reruns agree.

Targets: ``BUDGET`` times all words is shared by weight; a source stops at ``MAX_REPEAT`` times its
size and the excess is shared again among the rest until none is above. Each round is one
aggregate over the table of sources; only the sums reach the driver.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null source is a source of
its own, last in order; rows that repeat a ``doc_id`` are mixed one by one; an empty table gives no
rows; further columns pass through ``mix``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.functions.ranking import rank_within
from tastemap.llm import words as W
from tastemap.llm import workers
from tastemap.session import materialize

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_REPEAT = 2.0
BUCKET_ROWS = 2_000
FAN_IN = 64
SEED = 1


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, tie, size): words of every whole text; ``tie`` hashes the text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = W.text_bytes(batch.column("text"))
            n = [np.zeros(0, np.int64)]
            for i, j in W.chunks(off):
                n.append(np.diff(W.split_words(buf[off[i] : off[j]], off[i : j + 1] - off[i])[2]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "tie")), pa.array(np.concatenate(n))], names=["doc_id", "source", "tie", "size"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text").alias("tie"), F.col("text").cast("string"))
    return rows.mapInArrow(workers.tidy(task), "doc_id long, source string, tie long, size long")


def targets(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) of every source."""
    per = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = rank_within(per.withColumn("all", F.lit(1)), "all", [F.col("source").asc_nulls_last()], "pos")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (((F.col("pos") - 1) % len(weights)) + 1).cast("int"))
    src = materialize(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_repeat).alias("most")), "sources")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("most")
        capped, free, n = src.agg(F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))).first()
        if n == above or not free:
            break
        above, level = n, (budget * total - (capped or 0.0)) / free
    return src.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def pivotal(p: np.ndarray, s: np.ndarray, rng: np.random.Generator, last: bool) -> tuple[np.ndarray, int]:
    """Round the fractions ``p`` of documents of sizes ``s`` in order. Returns the rounded parts and
    the position of the undecided document (-1: none), whose part is its remaining fraction;
    ``last`` rounds that one too."""
    p = p.copy()
    held = -1
    u = rng.random(len(p) + 1)
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        up, down = min((1 - p[held]) * s[held], p[i] * s[i]), min(p[held] * s[held], (1 - p[i]) * s[i])
        if u[i] * (up + down) < down:  # words move from i to the held one
            if (1 - p[held]) * s[held] <= p[i] * s[i]:
                p[held], p[i], held = 1.0, p[i] - up / s[i], i
            else:
                p[held], p[i] = p[held] + up / s[held], 0.0
        else:
            if p[held] * s[held] <= (1 - p[i]) * s[i]:
                p[held], p[i], held = 0.0, p[i] + down / s[i], i
            else:
                p[held], p[i] = p[held] - down / s[held], 1.0
        if not 1e-12 < p[held] < 1 - 1e-12:
            p[held], held = round(p[held]), -1
    if last and held >= 0:
        p[held], held = float(u[-1] < p[held]), -1
    return p, held


NODE = "doc_id long, no_id boolean, source string, tie long, size long, source_size long, target double, whole long, part double, node long, open boolean"


def _round_groups(rows: DataFrame, last: bool, level: int, seed: int) -> DataFrame:
    """Round every (source, node) group; at most one row of it stays ``open``."""

    def group(rows: pa.Table) -> pa.Table:
        # large ones first: what is left undecided at the end is small
        size, doc_id, tie = (rows.column(c).to_numpy() for c in ("size", "doc_id", "tie"))
        rows = rows.take(pa.array(np.lexsort((tie, doc_id, -size))))
        name = rows.column("source")[0].as_py()
        text = f"{seed}|{level}|{rows.column('node')[0].as_py()}|{'' if name is None else 's' + name}"
        rng = np.random.default_rng(list(text.encode()))
        part, held = pivotal(rows.column("part").to_numpy(), rows.column("size").to_numpy().astype(float), rng, last)
        changed = {"part": pa.array(part), "open": pa.array(np.arange(len(part)) == held)}
        return pa.table({c: changed.get(c, rows.column(c)) for c in rows.column_names})

    return rows.groupBy("source", "node").applyInArrow(lambda t: group(t), NODE)


def copies(docs: DataFrame, seed: int = SEED, **shares) -> DataFrame:
    """(doc_id, source, tie, size, source_size, target, copies), one row per input row."""
    sized = materialize(sizes(docs), "sizes")
    target = targets(sized, **shares).withColumnRenamed("source", "of")
    n = sized.count()
    nodes = max(1, math.ceil(n / BUCKET_ROWS))
    times = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(target, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("times", times)
    rows = rows.select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
        "source", "tie", "size", "source_size", "target", F.floor("times").alias("whole"), (F.col("times") - F.floor("times")).alias("part"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tie")), F.lit(nodes)).alias("node"), F.lit(False).alias("open"),
    )
    level, decided = 0, []
    while True:
        done = materialize(_round_groups(rows, nodes == 1, level, seed), "rounded")
        decided.append(done.filter(~F.col("open")))
        if nodes == 1:
            break
        nodes, level = math.ceil(nodes / FAN_IN), level + 1
        rows = done.filter("open").withColumn("node", F.floor(F.col("node") / FAN_IN))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    doc_id = F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id")
    return out.select(doc_id, "source", "tie", "size", "source_size", "target", (F.col("whole") + F.col("part").cast("long")).alias("copies"))


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mix(docs: DataFrame, **args) -> DataFrame:
    """``docs`` (all columns) with every row repeated as often as the mix takes it."""
    p = W.fresh(docs.columns, "_m_")
    keys = [p + "key", p + "none", p + "text"]
    # plain equal keys, so that the join and the window share one shuffle of the texts
    as_keys = lambda doc_id, text: [F.coalesce(doc_id, F.lit(0).cast("long")).alias(keys[0]), doc_id.isNull().alias(keys[1]), text.alias(keys[2])]
    taken = copies(docs, **args).select(*as_keys(F.col("doc_id"), F.col("tie")), "copies").groupBy(*keys).agg(F.array_sort(F.collect_list("copies")).alias(p + "copies"))
    rows = docs.select("*", *as_keys(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))))
    joined = rows.join(taken.filter(F.array_max(p + "copies") > 0), keys)
    # equal rows share out their group's copies
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(p + "key"))
    times = joined.withColumn(p + "times", F.element_at(p + "copies", nth).cast("int")).filter(F.col(p + "times") > 0)
    out = times.withColumn(p + "copy", F.explode(F.sequence(F.lit(1), F.col(p + "times"))))
    return out.drop(*keys, *[p + c for c in ("copies", "times", "copy")])
