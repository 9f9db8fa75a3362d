"""Cases that once gave wrong results or stopped a job."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from tastemap.llm import decontaminate, jaccard, mixing, perplexity, secrets, substring, suffixes, tokens, warc
from tastemap.llm import words as W
from tests.llm.conftest import DOCS


def thue_morse(n, flip, a="a", b="b"):
    """Complementary words for flip 0 and 1: polynomials modulo 2^64 cannot tell them apart."""
    return "".join(b if bin(i).count("1") % 2 != flip else a for i in range(n))


X, Y = thue_morse(2048, 0), thue_morse(2048, 1)


def docs_of(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


def test_hashes_differ_where_the_bytes_do():
    rng = np.random.default_rng(0)
    texts = [X, Y, X + "a", "a", "b", "A", "ab", "ba", "x" * 8, "x" * 9, "x" * 16, "x" * 255, "x" * 256, "x" * 257, "x" * 258, "é", "É"]
    texts += ["".join(rng.choice(list("ab"), rng.integers(1, 40))) for _ in range(3000)]
    raw = " ".join(texts).encode()
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, _ = W.split_words(buf, np.array([0, len(raw)]))
    h = W.word_hashes(buf, starts, ends)
    assert len(set(h.tolist())) == len(set(texts))
    low = W.word_hashes(buf, starts, ends, lower=True)
    assert low[3] == low[5] and low[15] != low[16]  # A-Z only
    # wherever a word stands, its hash is the same
    again = np.frombuffer(b"zz " + raw, np.uint8)
    s2, e2, _ = W.split_words(again, np.array([0, len(again)]))
    assert (W.word_hashes(again, s2, e2)[1:] == h).all()


def test_span_hashes_modulo_a_prime():
    rng = np.random.default_rng(1)
    p = int(W.PRIME)
    a, b = rng.integers(0, p, 500, dtype=np.uint64), rng.integers(0, p, 500, dtype=np.uint64)
    assert [int(x) for x in W.times(a, b)] == [int(x) * int(y) % p for x, y in zip(a, b)]
    assert [int(x) for x in W.sums(a)[1:]] == [sum(map(int, a[: i + 1])) % p for i in range(500)]
    for n in (1024, 2048):
        units = np.frombuffer((thue_morse(n, 0) + thue_morse(n, 1) + thue_morse(n, 0)).encode(), np.uint8).astype(np.uint64)
        h = W.span_hashes(units, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
        assert h[0] == h[2] != h[1]


def test_complementary_words(spark):
    got = {r.doc_id: r.component_id for r in jaccard.join(docs_of(spark, (1, X), (2, Y), (3, X))).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    rows = substring.report(docs_of(spark, (1, " ".join([X] * 56)), (2, " ".join([Y] * 55)))).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: 0}
    seq = lambda f: " ".join(thue_morse(2048, f, "p ", "q ").split())
    rows = substring.report(docs_of(spark, (1, seq(0)), (2, seq(1)))).collect()
    assert {r.doc_id: r.n_words for r in rows} == {1: 2048, 2: 2048}
    want = brute_removed([seq(0).split(), seq(1).split()], 50)
    assert {r.doc_id: r.n_removed for r in rows} == {1: want[0], 2: want[1]}
    rows = suffixes.report(docs_of(spark, (1, X), (2, Y))).collect()
    want = brute_removed([list(X), list(Y)], 50)
    assert {r.doc_id: r.n_removed for r in rows} == {1: want[0], 2: want[1]}
    stats = perplexity.report(docs_of(spark, (1, f"{X} u v {Y} u v"), (2, f"{X} u v {X} u v"))).collect()
    assert {r.doc_id: r.n_repeat_words for r in stats} == {1: 0, 2: 6}


def brute_removed(texts, k):
    first, out = {}, []
    for d, w in enumerate(texts):
        for i in range(len(w) - k + 1):
            first.setdefault(tuple(w[i : i + k]), d)
    for d, w in enumerate(texts):
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone |= set(range(i, i + k))
        out.append(len(gone))
    return out


def test_token_ids_of_complementary_words(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokens.report(docs_of(spark, (1, X), (2, Y), (3, f"{Y} {X}"))).collect()}
    for i, t in ((1, X), (2, Y), (3, f"{Y} {X}")):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_repeated_ids_with_different_texts_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    df = docs_of(spark, (5, a), (5, b), (2, b), (9, a), (7, "alone here"))
    assert sorted((r.doc_id, r.component_id) for r in jaccard.join(df).collect()) == [(2, 2), (5, 2), (5, 2), (7, 7), (9, 2)]
    assert [r.doc_id for r in jaccard.keep_one(df).orderBy("doc_id").collect()] == [2, 7]


def test_mixing_keeps_large_ids_beside_a_null(spark):
    ids = [9007199254740993, 9007199254740995, None, 3]
    got = mixing.report(docs_of(spark, *[(i, "one two three " * 20) for i in ids])).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(ids, key=str)


def test_archive_of_pages_without_id(spark):
    long_ = "é" * 800
    rows = [(None, "u0", long_), (4, "u1", long_), (2, None, long_), (None, "u2", None), (None, "u3", "short")]
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    assert got == sorted([(None, 1600, "revisit", 4), (4, 1600, "response", None), (2, 1600, "revisit", 4), (None, 0, "response", None), (None, 5, "response", None)], key=str)


def test_item_without_id_hits_but_is_not_listed(spark):
    items = spark.createDataFrame([(None, "alpha beta"), (7, "gamma")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.report(docs_of(spark, (1, "x alpha beta y"), (2, "gamma alpha beta")), items).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1].contaminated) == (2, 0, True)
    assert (got[2].n_hit, got[2].n_items) == (3, 1) and got[2].items_sha256 == hashlib.sha256(b"7").hexdigest()


def test_text_with_many_secrets_takes_linear_time(spark):
    import time

    def took(n):
        df = docs_of(spark, (1, " é ".join(f"token=abc{i:06d}" for i in range(n))), (2, "no secret"))
        start = time.time()
        got = {r.doc_id: r for r in secrets.report(df).collect()}
        want = [(m.start(), m.end()) for m in re.finditer(r"token=[a-z0-9]+", " é ".join(f"token=abc{i:06d}" for i in range(n)))]
        base = ",".join(f"assign:{a}:{b}" for a, b in want)
        assert got[1].n_assign == n and got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and got[2].n_assign == 0
        return time.time() - start

    took(10)
    assert took(40_000) < 20


def test_a_worker_keeps_the_tables_of_one_operator(monkeypatch):
    from tastemap.llm import workers

    monkeypatch.setattr(workers, "_kept", {})
    first = workers.kept("tokens")
    first["x"] = 1
    assert workers.kept("tokens") is first
    assert workers.kept("other") == {} and list(workers._kept) == ["other"]
    workers.free()
    assert workers._kept == {}


def test_a_task_leaves_no_unused_memory():
    import re

    from tastemap.llm import workers

    def anonymous_mb():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024

    pins = []

    def task(batches):
        for _ in batches:
            held = [bytes(2000) for _ in range(100_000)]  # 200 MB, of which scattered pieces stay
            pins.extend(held[::200])
            yield anonymous_mb()

    workers.free()
    before = anonymous_mb()
    (most,) = workers.tidy(task)(iter([0]))
    assert most > before + 150
    assert anonymous_mb() < before + 50


def test_a_task_frees_other_tables_when_it_ends(monkeypatch):
    from tastemap.llm import workers

    monkeypatch.setattr(workers, "_kept", {"old": {"x": 1}})

    def task(batches):
        assert workers._kept == {}
        workers.kept("tokens")["x"] = 1
        yield from batches

    assert list(workers.tidy(task, "tokens")(iter([1, 2]))) == [1, 2]
    assert workers._kept == {"tokens": {"x": 1}}
    assert list(workers.tidy(lambda batches: batches)(iter([3]))) == [3]
    assert workers._kept == {}
