import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def words(rng, n):
    parts = ["an", "the", "ing", "tion", "er", "on", "st", "é", "ou", "nd", "ha", "ble"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Rows with exact and near copies, shared passages, nulls, empty and long texts, repeated lines."""
    rng = random.Random(5)
    passage = words(rng, 60)
    base = words(rng, 300)
    texts = [None, "", "   \n\t", "one", "one two three", "ONE two Three", " ".join(base), " ".join(base)]
    for i in range(6):  # near copies
        w = list(base)
        w[10 * i + 5] = "changed%d" % i
        texts.append(" ".join(w))
    w = list(base)
    for i in range(0, 300, 12):
        w[i] = "x%d" % i
    texts.append("\n".join(w))  # a far copy
    for i in range(8):
        texts.append(" ".join(words(rng, 40) + passage + words(rng, rng.randint(0, 90))))
    texts.append(" ".join(words(rng, 9000)))
    texts.append("same line here\n" * 40 + " ".join(words(rng, 60)))
    texts += [" ".join(words(rng, rng.randint(1, 200))) for _ in range(25)]
    texts.append("k" * 3000)
    texts.append("k" * 3000)
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "b", "é", None]), 0) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """``df`` with further columns that the operators use inside."""
    from pyspark.sql import functions as F

    for c in ("g", "b", "n", "id", "size", "part", "row", "digest", "_found", "_q_n_words", "_m_key", "_j_id", "band_lang", "_band_lang", "tie", "component_id"):
        df = df.withColumn(c, F.lit("clash"))
    return df
