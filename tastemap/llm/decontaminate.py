"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and items are normalised alike: A-Z lower-cased, words are runs of bytes outside
``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F``, joined by single spaces with one at either end. The
patterns are all windows of 13 consecutive item words (an item of fewer words is one window),
each between spaces, so a match always covers whole words. Every text is scanned once; a match's
end maps to word numbers and from there to offsets in the original text.

The items are collected into the automaton, so their bytes are checked first: up to
``MAX_AUTOMATON_BYTES`` of patterns there is one automaton, broadcast once; a larger benchmark is
cut into ranges of items and the texts are scanned once per range, with the same result.

Defined cases: a null or empty text has no words, no hit and is clean; a null ``item_id`` hits words
but is not listed; an item without words (or
null) never occurs; rows that repeat an ``item_id`` are one item with the windows of all; rows that
repeat a ``doc_id`` are judged one by one; an empty benchmark or table gives clean or no rows;
further columns pass through ``scan``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemap.llm import words as W
from tastemap.llm import workers

WINDOW = 13
MIN_SHARE_OF_WORDS = 20  # contaminated: 20 * n_hit >= n_words
MAX_AUTOMATON_BYTES = 64_000_000
HELD_BYTES = 16 << 20

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
NORMAL = bytes(int(W.LOWER[b]) if WORD[b] else 32 for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(text: str | None, k: int = WINDOW) -> list[bytes]:
    w = normal_words((text or "").encode())
    if not w:
        return []
    return [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]


def build(items: list[tuple[object, str | None]], k: int = WINDOW) -> ahocorasick.Automaton | None:
    """Automaton whose values are (number of words, the item ids as strings)."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in item_windows(text, k):
            owners.setdefault(w, set()).update(() if item is None else (str(item),))
    if not owners:
        return None
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        # one character per byte
        a.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(sorted(ids))))
    a.make_automaton()
    return a


def find(automaton: ahocorasick.Automaton | None, text: bytes) -> tuple[int, np.ndarray, set[str]]:
    """(number of words, flag per word: inside an occurrence, items with occurring windows)."""
    w = normal_words(text)
    if automaton is None or not w:
        return len(w), np.zeros(len(w), bool), set()
    line = f" {b' '.join(w).decode('latin-1')} "
    first, last, items = [], [], set()
    spaces = None
    for end, (n, ids) in automaton.iter(line):
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        stop = int(np.searchsorted(spaces, end))  # the match ends at the space after word stop - 1
        first.append(stop - n)
        last.append(stop)
        items.update(ids)
    if not first:
        return len(w), np.zeros(len(w), bool), items
    return len(w), W.join_ranges(np.array(first), np.array(last), len(w)), items


def original_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of the original text that the runs of hit words cover."""
    if not hit.any():
        return []
    starts, ends, _ = W.split_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), WORD)
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [(int(starts[i]), int(ends[j - 1])) for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def automata(items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = WINDOW, max_bytes: int = MAX_AUTOMATON_BYTES) -> Iterator[ahocorasick.Automaton]:
    """The automaton over ``items``; several, one after another, where the windows (at most k times the text)
    exceed ``max_bytes``."""
    items = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size * k // max_bytes) + 1
    part = F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(parts))
    for p in range(parts):
        a = build((items if parts == 1 else items.filter(part == p)).collect(), k)
        if a:
            yield a


def scan(docs: DataFrame, items: DataFrame, text_col: str = "text", k: int = WINDOW, out_col: str = "_found", max_bytes: int = MAX_AUTOMATON_BYTES) -> DataFrame:
    """``docs`` (all columns) with a struct of words, hit words, occurring items and the byte spans
    of hit words in the original text. A row-local pass: no shuffle. Of several automata, driver and tasks
    hold one at a time; batches of texts up to ``HELD_BYTES`` meet them in turn."""
    tries = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(items, k=k, max_bytes=max_bytes)]
    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, FOUND)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))])
        for held in W.gathered(batches, HELD_BYTES if len(tries) > 1 else 0):
            texts = [[t.as_py() or b"" for t in batch.column(text_col).cast(pa.large_binary())] for batch in held]
            found: list[list[tuple]] = [[] for _ in held]
            for each in tries or [None]:
                automaton = each.value if each else None
                for k, part in enumerate(texts):
                    now = [find(automaton, t) for t in part]
                    found[k] = [(n, hit | more, ids | others) for (n, hit, ids), (_, more, others) in zip(found[k], now, strict=True)] if found[k] else now
                if len(tries) > 1:
                    each.__dict__.pop("_value", None)  # read again for the next texts
            for batch, part, of in zip(held, texts, found, strict=True):
                rows = [{"n_words": n, "n_hit": int(hit.sum()), "items": sorted(ids), "spans": [list(x) for x in original_spans(t, hit)]} for t, (n, hit, ids) in zip(part, of, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, out_col])

    return docs.mapInArrow(workers.tidy(task), schema)


def contaminated(found: str = "_found"):
    return (F.col(f"{found}.n_hit") > 0) & (MIN_SHARE_OF_WORDS * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The query's columns."""
    found = scan(docs.select("doc_id", "text"), items)
    ids = F.array_sort(F.col("_found.items"))
    return found.select(
        "doc_id",
        F.col("_found.n_words").alias("n_words"),
        F.col("_found.n_hit").alias("n_hit"),
        F.size("_found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not contaminated."""
    found = W.fresh(docs.columns, "_found")
    return scan(docs, items, out_col=found).filter(~contaminated(found)).drop(found)


def digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
