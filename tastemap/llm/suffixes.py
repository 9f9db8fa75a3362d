"""Suffix-array dedup over bytes by depth-limited radix sort.

Suffixes of all texts are ordered through their first 50 bytes only, most significant digit first.
The first digit that the cluster sees is the minimiser of the suffix's first 50 bytes: equal prefixes
have equal minimisers, so suffixes part into buckets that cannot hold equals of each other
(``repeats``), travel there as packed strings, and a minimiser that no other document has is a group
of one, done after this pass. Within a bucket each pass takes the next eight bytes as the digit,
sorts every open group by it and closes the groups of one; groups left at depth 50 are exactly the
repeated windows, and the least document of each group goes to all its members.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller ``doc_id``;
matches never cross documents and are judged on the input.

Defined cases: a null or empty text has no bytes (digest of the empty string); texts under 50 bytes
stay; strings that repeat only inside one document, or in rows that repeat a ``doc_id``, stay; a
null ``doc_id`` counts as the smallest; kept bytes need not be whole characters, so the kept text
is binary; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastemap.llm import repeats

WINDOW = 50
DIGIT = 8


def radix_groups(data: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, group of each): the positions ``at`` whose first ``depth`` bytes occur more than once
    within their start group, by most-significant-digit passes."""
    member, group = np.arange(len(at)), group.astype(np.int64)
    raw = np.zeros(len(data) + DIGIT, np.uint8)
    raw[: len(data)] = data
    eight = np.ndarray(len(data) + 1, ">u8", raw.data, strides=(1,))
    for d in range(0, depth, DIGIT):
        digit = eight[at[member] + d].astype(np.uint64) >> np.uint64(8 * max(0, d + DIGIT - depth))
        order = np.argsort(digit)
        for bit in range(0, int(group.max(initial=0)).bit_length(), 16):
            order = order[np.argsort((group[order] >> bit).astype(np.uint16), kind="stable")]
        g, x = group[order], digit[order]
        new = np.ones(len(order), bool)
        new[1:] = (g[1:] != g[:-1]) | (x[1:] != x[:-1])
        label = np.cumsum(new) - 1
        alone = np.bincount(label, minlength=1)[label] < 2 if len(label) else np.zeros(0, bool)
        member, group = member[order][~alone], label[~alone]
    return member, group


def least_docs(keys: np.ndarray, strings: list[bytes], docs: np.ndarray, k: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The least document of each 50-byte string of all packed strings, and how many each of these has."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    n = np.array([len(s) for s in strings])
    windows = n - k + 1
    at = repeats.spread(np.cumsum(n) - n, windows)
    least = np.repeat(docs, windows)
    start = np.unique(keys, return_inverse=True)[1]
    member, group = radix_groups(data, at, np.repeat(start, windows), k)
    if len(member):
        low = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group, least[member])
        least[member] = low[group]
    return least, windows


def _finish(with_bytes: bool):
    def finish(buf, off, first, covered) -> dict:
        edge = covered.copy()
        edge[1:] &= ~covered[:-1]
        starts = off[:-1][off[:-1] < len(buf)]
        edge[starts] = covered[starts]
        n, gone = np.diff(off), repeats.row_sums(covered, first)
        rest, ends = buf[~covered].tobytes(), np.cumsum(n - gone).tolist()
        kept = [rest[a:b] for a, b in zip([0, *ends], ends)]
        out = {
            "n_bytes": pa.array(n),
            "n_removed": pa.array(gone),
            "n_spans": pa.array(repeats.row_sums(edge, first)),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        return out | ({"kept": pa.array(kept, pa.binary())} if with_bytes else {})

    return finish


def dedup(docs: DataFrame, k: int = WINDOW, with_bytes: bool = True, group_bytes: int = repeats.GROUP_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])"""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return repeats.remove(docs, repeats.Bytes(k), lambda a, b, c: least_docs(a, b, c, k), _finish(with_bytes), schema, group_bytes)


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return dedup(docs, with_bytes=False)
