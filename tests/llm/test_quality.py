"""The quality verdict against a whole brute-force version, and on shuffled and labelled documents."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tastemap.llm import perplexity
from tests.llm.conftest import DOCS, words
from tests.llm.reference import Model

SF = "/root/testdata/sf0.01"


def base_failed(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {j for k in range(len(w) - 2) if c[w[k], w[k + 1], w[k + 2]] > 1 for j in (k, k + 1, k + 2)}
    return len(w) < 50 or 100 * len(covered) > 50 * len(w)


def grams(t):
    raw = (t or "").encode()
    return perplexity.grams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[1]


def low_median(values):
    """The middle value, the lower one of two: what percentile_approx returns."""
    return sorted(values)[(len(values) - 1) // 2]


def brute_kept(rows):
    """doc_id -> verdict, everything in memory."""
    of = defaultdict(list)
    for _, t, lang, *_ in rows:
        of[lang].append(grams(t))
    value = {}
    for lang, gs in of.items():
        g = np.concatenate([np.zeros(0, np.uint64), *gs])
        if len(g):
            counts = np.unique(g, return_counts=True)
            value[lang] = Model(*counts), Model(*counts, top=3)
    nll, per = {}, defaultdict(set)
    for i, t, lang, *_ in rows:
        g = grams(t)
        nll[i] = tuple(float(-np.log(m.probability(g)).mean()) for m in value[lang]) if len(g) else None
        if not base_failed(t) and nll[i]:
            per[lang].add(tuple(round(x, 12) for x in nll[i]))
    kept = {}
    for i, t, lang, *_ in rows:
        if base_failed(t):
            kept[i] = False
            continue
        z = []
        for k in (0, 1):
            v = [x[k] for x in per[lang]]
            mid = low_median(v)
            z.append((nll[i][k] - mid) / (max(1.4826 * low_median([abs(x - mid) for x in v]), 0.005) + 0.25 / len(v)))
        kept[i] = z[0] <= 4 and -10 <= z[1] <= 4 and max(z[0], 0) + max(z[1], 0) <= 5
    return kept


def test_kept_matches_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for lang in ("en", "de", None):
        for i in range(70):
            w = words(rng, rng.randint(40, 200))
            if i % 9 == 0:
                w = [x + rng.choice(["$$$", "###"]) for x in w]
            if i % 11 == 0:
                w = ["an", "the"] * 60
                rng.shuffle(w)
            rows.append((len(rows), " ".join(w), lang, "s", 0))
    rows += [(len(rows) + i, rows[1][1], "en", "s", 0) for i in range(30)]
    rows += [(-1, None, "en", "s", 0), (-2, "", "xx", "s", 0), (-3, " ".join(words(rng, 90)), "yy", "s", 0)]
    got = {r.doc_id: r.kept for r in perplexity.report(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    want = brute_kept(rows)
    assert got == want and 20 < sum(not k for k in want.values()) < len(want) / 2


def test_shuffled_and_labelled_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").toPandas()
    label = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").toPandas().itertuples(index=False))
    rng = random.Random(1)
    rows = [tuple(r) for r in docs.itertuples(index=False)]
    passing = [r for r in rows if not base_failed(r[1])]
    shuffled = []
    for i, r in enumerate(passing[::12]):
        w = r[1].split()
        rng.shuffle(w)
        if not base_failed(" ".join(w)):
            shuffled.append((10**7 + i, " ".join(w), *r[2:]))
    got = {r.doc_id: r.kept for r in perplexity.report(spark.createDataFrame([(int(a), b, c, d, 0) for a, b, c, d, _ in rows + shuffled], DOCS)).collect()}
    share = lambda ids: np.mean([not got[i] for i in ids])
    assert share([r[0] for r in shuffled]) > 0.5
    assert share([r[0] for r in passing if label.get(r[0]) == 0]) > 0.8
    assert share([r[0] for r in passing if label.get(r[0]) == 1]) < 0.03
