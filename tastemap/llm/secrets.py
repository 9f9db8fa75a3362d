"""Secret scan with corpus-wide ownership frequency.

Base spans are three fixed patterns. The method widens them with token-like strings and then asks
the corpus whose they are: the hash of every candidate value is aggregated over distinct
repositories (rows) and distinct owners (sources). A value that several owners hold is a copied
example or a public identifier; a value that only one owner holds is a live-looking credential.

Everything is built-in DataFrame functions. The scan writes the few candidates (never texts) to
the shared checkpoint folder, so the patterns run once; the frequency aggregation is two-level
(value, owner) then (value), so a value held by a third of all rows is combined before it is
shuffled, and the join back is one row per value against the candidates (AQE splits a hot value).

Defined cases: a null or empty text has no spans (digest of the empty string); rows that repeat a
``doc_id`` each get their own spans, and count as one repository; a null owner is an owner of its
own; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemap.session import materialize

# The base patterns, in their listed order, with the least length of the match
# (``assign``: of group 2).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEN, ACCESS_LEN, HEX_LEN = 6, 20, 24

#: The method's own candidates: long unbroken tokens that mix lower case, upper case and digits.
TOKEN = r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])(?=[A-Z0-9_/+-]*[a-z])(?=[a-z0-9_/+-]*[A-Z])[A-Za-z0-9_/+-]{20,}"

#: A value held by more owners than this is a copied example.
MAX_OWNERS = 1

KINDS = ("assign", "access", "hex")


FOUND = "array<struct<ord:int,gap:int,len:int,value:string>>"


def _matches(text: Column, pattern: str, order: int, group: int = 0) -> Column:
    """The leftmost non-overlapping matches in order: the characters before each since the last one, its
    length and its value. ``length`` counts code points."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
    found = F.zip_with(
        F.arrays_zip(whole.alias("match"), parts.alias("value")),
        gaps,
        lambda m, g: F.struct(F.lit(order).alias("ord"), F.length(g).alias("gap"), F.length(m["match"]).alias("len"), m["value"].alias("value")),
    )
    return F.when(F.size(whole) > 0, found).otherwise(F.array().cast(FOUND))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """(id, owner, found): the matches of the base patterns and of the method's own in every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a run matches as a whole, so the least length can be part of the pattern; for ``assign`` it
    # cannot, as a failing match still uses up its text
    assign = _matches(text, ASSIGN, 0, group=2)
    access = _matches(text, ACCESS.replace("+", f"{{{ACCESS_LEN - 4},}}"), 1)
    hexes = _matches(text, HEX.replace("+", f"{{{HEX_LEN},}}"), 2)
    token = _matches(text, TOKEN, 3)
    return docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"), F.concat(assign, access, hexes, token).alias("found"))


def positions(cands: DataFrame) -> DataFrame:
    """(row, id, owner, start, ord, kind, end, value), one row per span. Positions are running sums over a
    row's matches of a kind, so the work is linear in them."""
    each = cands.filter(F.size("found") > 0).select("row", "id", "owner", F.posexplode("found").alias("at", "f")).select("row", "id", "owner", "at", "f.*")
    so_far = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("row", "ord").orderBy("at"))
    kind = F.element_at(F.array(*[F.lit(k) for k in (*KINDS, "token")]), F.col("ord") + 1)
    each = each.withColumn("end", so_far.cast("int")).filter((F.col("ord") != 0) | (F.length("value") >= ASSIGN_LEN))
    return each.select("row", "id", "owner", (F.col("end") - F.col("len")).alias("start"), "ord", kind.alias("kind"), "end", "value")


def ownership(each: DataFrame) -> DataFrame:
    """(value_hash, n_repos, n_owners) over all candidates of the corpus; hashes only."""
    each = each.select("id", "owner", _hash(F.col("value")).alias("value_hash"))
    repos = each.groupBy("value_hash", "owner", "id").agg(F.lit(1).alias("one"))
    by_owner = repos.groupBy("value_hash", "owner").agg(F.count("one").alias("repos"))
    return by_owner.groupBy("value_hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def _hash(value: Column) -> Column:
    return F.sha2(value, 256)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per input row: ``id``, ``base`` spans, ``spans`` (base and live-looking candidates,
    each with its value, ``n_repos``, ``n_owners`` and ``live``)."""
    cands = materialize(candidates(docs, id_col, text_col, owner_col).withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = materialize(positions(cands), "spans")
    judged = each.withColumn("value_hash", _hash(F.col("value"))).join(ownership(each), "value_hash").withColumn("live", F.col("n_owners") <= max_owners)
    place = [F.col(c) for c in ("start", "ord", "kind", "end", "value")]
    is_base = F.col("ord") < len(KINDS)
    rows = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(is_base, F.struct(*place)))).alias("base"),
        F.array_sort(F.collect_list(F.when(is_base | F.col("live"), F.struct(*place, "n_repos", "n_owners", "live")))).alias("spans"),
    )
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int,value:string>>")
    out = cands.drop("found").join(rows, "row", "left")
    return out.select("id", F.coalesce("base", none).alias("base"), "spans")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    found = scan(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    # size(null) is -1 in non-ANSI sessions
    spans = F.when(F.col("spans").isNull(), F.lit("")).otherwise(_joined(F.col("spans")))
    live = F.when(F.col("spans").isNull(), F.lit(0)).otherwise(F.size(F.filter("spans", lambda s: s["live"])))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k) for k in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        spans.alias("spans"),
        live.cast("long").alias("n_live"),
    )
