"""Substring dedup over words by super-k-mer partitioning.

Consecutive windows of 50 words that share a minimiser (least hash of their 6-word grams) travel as one
packed string to the minimiser's bucket (``repeats``). There every distinct string is cut back into
its windows, the windows of a bucket are sorted, and equal neighbours give each window its least
document. Sorting is exact: words are numbered by their bytes, and windows are ranked by doubling
(pairs of ranks of 1, 2, 4 ... words), so no hash decides their
equality; a packed string is known by its minimiser and a hash of its words together.

A word goes if a window that covers it also starts in a document with a smaller ``doc_id``; windows
are judged on the input.

Defined cases: a null or empty text has no words (digest of the empty string); texts of fewer than
50 words stay; windows that repeat only inside one document, or in rows that repeat a ``doc_id``,
stay; a null ``doc_id`` counts as the smallest; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastemap.llm import repeats

WINDOW = 50


def window_ranks(ids: np.ndarray, k: int) -> np.ndarray:
    """Rank of every window of k ids by sorted order: equal ranks are equal windows."""
    rank, span = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1 if len(b) else 1) + b, return_inverse=True)[1].astype(np.int64)

    while span * 2 <= k:
        rank = paired(rank[:-span], rank[span:])
        span *= 2
    if span < k:
        n = len(ids) - k + 1
        rank = paired(rank[:n], rank[k - span : k - span + n])
    return rank


def least_docs(keys: np.ndarray, strings: list[bytes], docs: np.ndarray, k: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The least document of each window of all packed strings, and how many windows each has."""
    number: dict[bytes, int] = {}
    words = [s.split() for s in strings]
    ids = np.array([number.setdefault(w, len(number)) for s in words for w in s], np.int64)
    n = np.array([len(s) for s in words])
    rank = window_ranks(ids, k)  # windows across two strings are ranked too, and not looked at
    windows = n - k + 1
    r = rank[repeats.spread(np.cumsum(n) - n, windows)]
    least = np.full(int(rank.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, r, np.repeat(docs, windows))
    return least[r], windows


def _finish(with_text: bool):
    def finish(buf, off, first, covered) -> dict:
        raw, digests, texts = buf.tobytes(), [], []
        for a, b, gone in zip(off[:-1].tolist(), off[1:].tolist(), repeats.split_rows(covered, first), strict=True):
            words = raw[a:b].split()
            kept = b" ".join(compress(words, (~gone).tolist()) if gone.any() else words)
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode() if with_text else None)
        out = {"n_words": pa.array(np.diff(first)), "n_removed": pa.array(repeats.row_sums(covered, first)), "kept_sha256": pa.array(digests, pa.string())}
        return out | ({"text": pa.array(texts, pa.string())} if with_text else {})

    return finish


def dedup(docs: DataFrame, k: int = WINDOW, with_text: bool = True, group_bytes: int = repeats.GROUP_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, text]) with the kept words as ``text``."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return repeats.remove(docs, repeats.Words(k), lambda a, b, c: least_docs(a, b, c, k), _finish(with_text), schema, group_bytes)


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return dedup(docs, with_text=False)
