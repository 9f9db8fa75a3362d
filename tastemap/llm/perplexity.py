"""Quality rules with an n-gram language model.

Per document: simple text statistics, and two mean negative log probabilities per byte (the log of
the perplexity) under interpolated modified Kneser-Ney models of the document's language: one of order
5 (``nll``) and one of order 3 (``nll3``).

Models. Byte n-grams with white space folded; case is kept, as capitals after full stops are
what order there is between words of prose. Every task counts the n-grams of all its texts with sorted
arrays (a map-side combine of bounded size), Spark sums the counts by (language, n-gram). No n-gram is
left out, however rare it or its language is; trigrams are sums of these. Lower orders of a model use
continuation counts; each order has the three discounts of modified Kneser-Ney from the counts of counts of its language. All of it is built by
Spark: a context has at most 256 n-grams, so no group is larger. A model is stored as arrays sorted by
(language, n-gram) in files of the shared folder (``LanguageModel``), neither collected nor broadcast. A
scoring task looks up the distinct n-grams of ``GROUP_BYTES`` of text at a time by binary search in the
languages and key ranges that these need; small models stay in the task's memory (``CACHE_ROWS``),
larger ones are read per group, so memory follows neither the corpus nor the model. Texts that the
model was not fitted on are scored too: missing n-grams back off as usual, down to 1 / 256.

Bands. Per language, median and scaled median absolute deviation (s) of both values over the documents
that pass the base rules, equal values (exact copies) counted once. A document is rejected if its
trigram perplexity is more than ``BAND`` s above or ``LOW`` s below the median, if its full one is more than
``BAND`` s above it, or if both are above it by more than ``JOINT`` s together. Symbols, tables and shuffled words are
above; strings of a few common words below. At full order there is no lower band: a text that the corpus
holds a thousand times is predicted from its copies there, while at the order of trigrams even a text
with a third of the corpus stays inside. s is ``LEAST_S`` at least, and 1 / 4n nats more for n values, as
a few values say little; there is no other dependence on size.

Defined cases: a null or empty text has no words, fails the base rules and has no perplexity; a
null language is a language of its own; rows that repeat a ``doc_id`` are judged one by one; an
empty table gives an empty result; further columns pass through ``annotate``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemap.llm import words as W
from tastemap.llm import workers
from tastemap.llm.files import open_fs
from tastemap.session import materialize

ORDER, LOW_ORDER = 5, 3
BAND, JOINT, LOW = 4.0, 5.0, 10.0
LEAST_S = 0.005
#: Width of a language code's place above an n-gram.
SHIFT = W.U(8 * ORDER)

GROUP_BYTES = 6 << 20
TABLE_ROWS = 1 << 18
CACHE_ROWS = 3_000_000
HELD_GRAMS = 1_000_000

MIN_WORDS = 50
MAX_REPEAT_PCT = 50

# The symbols that count, ``[#*$%&|<>]``
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

NLL = ("nll", "nll3")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# ---------------------------------------------------------------- text statistics
def text_stats(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, 5) statistics in the order of ``STATS``."""
    n = len(off) - 1
    out = np.zeros((n, 5), np.int64)
    starts, ends, first = W.split_words(buf, off)
    out[:, 0] = np.diff(first)
    lead = (buf & 0xC0) != 0x80  # a code point begins here
    out[:, 1] = _per_row(lead & W.NOT_SPACE[buf], off)
    out[:, 2] = _per_row(SYMBOLS[buf], off)
    # lines: split at \n, as words of the table "not \n"; their hash stands for their bytes
    line = np.ones(256, bool)
    line[10] = False
    ls, le, lfirst = W.split_words(buf, off, line)
    if len(ls):
        has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
        row = W.rows_of(lfirst)[has_word]
        key = W.fmix(W.word_hashes(buf, ls, le)[has_word] + row.astype(np.uint64) * W.STEP)
        _, at = np.unique(key, return_index=True)
        later = np.ones(len(key), bool)
        later[at] = False
        out[:, 3] = np.bincount(row[later], minlength=n)
    if len(starts) >= 3:
        at, h = W.windows(W.word_hashes(buf, starts, ends), first, 3)
        row = W.rows_of(first)
        key = W.fmix(h + row[at].astype(np.uint64) * W.STEP)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        covered = np.zeros(len(starts), bool)
        for j in range(3):
            covered[hit + j] = True
        out[:, 4] = np.bincount(row[covered], minlength=n)
    return out


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return c[off[1:]] - c[off[:-1]]


# ---------------------------------------------------------------- n-grams
def grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram) of every predicted byte: white space as single spaces, each row preceded by
    spaces. The last byte of the packed n-gram is the predicted one."""
    space = ~W.NOT_SPACE[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[keep]
    b = np.where(space[keep], 32, buf[keep]).astype(np.uint64)
    newrow = np.ones(len(b), bool)
    newrow[1:] = row[1:] != row[:-1]
    age = np.arange(len(b)) - np.repeat(np.flatnonzero(newrow), np.diff(np.append(np.flatnonzero(newrow), len(b))))
    g = b.copy()
    for j in range(1, ORDER):
        prev = np.full(len(b), 32, np.uint64)
        prev[j:] = b[:-j] if j < len(b) else prev[j:]
        prev[age < j] = 32
        g |= prev << W.U(8 * j)
    return row, g


def _languages(col: pa.Array) -> tuple[list[str], np.ndarray]:
    """(names, number of each row's name); the null language is named U+0000."""
    at: dict[str, int] = {}
    codes = [at.setdefault("\x00" if x is None else x, len(at)) for x in col.to_pylist()]
    return list(at), np.array(codes, np.int64)


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in batches:
            buf, off = W.text_bytes(batch.column("text"))
            names, langs = _languages(batch.column("lang"))
            for i, j in W.chunks(off):
                row, g = grams(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                row_lang = langs[i:j]
                for code in np.unique(row_lang).tolist():
                    k, c = np.unique(g[(row_lang == code)[row]], return_counts=True)
                    held.setdefault(names[code], []).append((k, c.astype(np.int64)))
                    size += len(k)
                if size > HELD_GRAMS:  # combine what is held; pass it on if little came of that
                    held = {lang: [_merge(runs)] for lang, runs in held.items()}
                    size = sum(len(runs[0][0]) for runs in held.values())
                    if 2 * size > HELD_GRAMS:
                        yield from _count_rows(held)
                        held, size = {}, 0
        yield from _count_rows(held)

    return (
        docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .mapInArrow(workers.tidy(task), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def _merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(runs) == 1:
        return runs[0]
    k = np.concatenate([r[0] for r in runs])
    order = np.argsort(k, kind="stable")  # sorted runs: a merge
    k = k[order]
    head = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[head], np.add.reduceat(np.concatenate([r[1] for r in runs])[order], head) if len(head) else np.zeros(0, np.int64)


def _count_rows(held) -> Iterator[pa.RecordBatch]:
    for lang, runs in held.items():
        k, c = _merge(runs)
        for i in range(0, len(k), 100_000):
            n = len(k[i : i + 100_000])
            yield pa.record_batch({"lang": pa.array([lang] * n, pa.string()), "gram": pa.array(k[i : i + n].astype(np.int64)), "n": pa.array(c[i : i + n])})


# ---------------------------------------------------------------- modified Kneser-Ney
def _discount_columns(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): ``_discounts`` of every language."""
    n = level.groupBy("lang").agg(*[F.sum((F.col("cnt") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)])
    n1, n2, n3, n4 = (F.col(f"n{i}") for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, F.when(n3 > 0, 3 - 4 * y * n4 / n3).otherwise(0.9)]
    enough = (n1 > 0) & (n2 > 0)
    return n.select("lang", *[F.when(enough, F.least(F.greatest(x, F.lit(0.05)), F.lit(i - 0.05))).otherwise(few).alias(f"d{i}") for i, x, few in zip((1, 2, 3), d, (0.5, 0.75, 0.9))])


class LanguageModel:
    """The models of all languages as sorted arrays in files of the shared folder. ``probs[n]``: (lang, key,
    nats) of all n-grams, ``backoff[n]``: (lang, key, nats) of all their contexts; nats are negative logs."""

    def __init__(self, counts: DataFrame, top: int = ORDER):
        """``counts``: (lang, gram, n) of order ``ORDER``, written once."""
        self.top = top
        level = counts.select("lang", F.col("gram").alias("key"), F.col("n").alias("cnt"))
        if top < ORDER:
            level = materialize(level.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 8 * top) - 1)).alias("key")).agg(F.sum("cnt").alias("cnt")), f"grams{top}")
        levels = {top: level}
        for n in range(top - 1, 0, -1):
            level = level.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 8 * n) - 1)).alias("key")).agg(F.count("*").alias("cnt"))
            levels[n] = level = materialize(level, f"grams{n}")
        parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        arrays = lambda df, name: materialize(df.repartitionByRange(parts, "lang", "key").sortWithinPartitions("lang", "key"), name)
        self.cache: dict[str, list] = {}
        self.probs: dict[int, list[str]] = {}
        self.backoff: dict[int, list[str]] = {}
        lower = None
        for n in range(1, top + 1):
            w = Window.partitionBy("lang", "ctx")
            of = levels[n].withColumn("ctx", F.shiftright("key", 8)).join(_small(materialize(_discount_columns(levels[n]), "discounts")), "lang")
            # whole numbers are summed, so the result does not depend on the order of rows
            of = of.withColumns({"total": F.sum("cnt").over(w), "c1": F.sum((F.col("cnt") == 1).cast("long")).over(w), "c2": F.sum((F.col("cnt") == 2).cast("long")).over(w), "types": F.count("*").over(w)})
            gamma = (F.col("d1") * F.col("c1") + F.col("d2") * F.col("c2") + F.col("d3") * (F.col("types") - F.col("c1") - F.col("c2"))) / F.col("total")
            use = F.when(F.col("cnt") == 1, F.col("d1")).when(F.col("cnt") == 2, F.col("d2")).otherwise(F.col("d3"))
            of = of.select("lang", "key", "ctx", gamma.alias("gamma"), ((F.col("cnt") - use) / F.col("total")).alias("own"), F.col("key").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)).alias("suffix"))
            of = of.withColumn("base", F.lit(1.0 / 256)) if lower is None else of.join(lower.select("lang", F.col("key").alias("suffix"), F.exp(-F.col("nats")).alias("base")), ["lang", "suffix"])
            built = arrays(of.select("lang", "key", "ctx", (-F.log("gamma")).alias("gamma_nats"), (-F.log(F.col("own") + F.col("gamma") * F.col("base"))).alias("nats")), f"model{n}")
            lower = built.select("lang", "key", "nats")
            self.probs[n] = list(built.inputFiles())
            self.backoff[n] = list(arrays(built.groupBy("lang", F.col("ctx").alias("key")).agg(F.first("gamma_nats").alias("nats")), f"backoff{n}").inputFiles())

    def nats(self, need: np.ndarray, codes: dict[str, int]) -> np.ndarray:
        """Negative log probability of the last byte of each n-gram. ``need``: distinct sorted
        code << SHIFT | n-gram, the code being the number of the language in ``codes``."""
        out = np.zeros(len(need))
        open_ = np.arange(len(need))
        for n in range(self.top, 0, -1):
            if not len(open_):
                return out
            low = W.U((1 << 8 * n) - 1)
            lang, gram = need[open_] >> SHIFT << SHIFT, need[open_] & low
            value, hit = self._look_up(self.probs[n], lang | gram, codes)
            out[open_[hit]] += value[hit]
            open_, lang, gram = open_[~hit], lang[~hit], gram[~hit]
            if len(open_):
                value, known = self._look_up(self.backoff[n], lang | gram >> W.U(8), codes)
                out[open_[known]] += value[known]
        out[open_] += np.log(256.0)
        return out

    def _arrays(self, uri: str, need: Callable[[str, int, int], bool]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(language, sorted keys, nats) of a file, piece by piece; pieces that ``need`` (by language and range
        of keys) turns down are not read. Small files are kept for the task's next look-up."""
        if uri in self.cache:
            yield from self.cache[uri]
            return
        fs, path = open_fs(unquote(uri))
        with fs.open_input_file(path) as f:
            file = pq.ParquetFile(f, read_dictionary=["lang"])
            keep = sum(len(k) for runs in self.cache.values() for _, k, _ in runs) + file.metadata.num_rows <= CACHE_ROWS
            found = []
            at = {file.metadata.schema.column(i).name: i for i in range(file.metadata.num_columns)}
            for g in range(file.metadata.num_row_groups):
                group = file.metadata.row_group(g)
                lang, key = group.column(at["lang"]).statistics, group.column(at["key"]).statistics
                if not keep and lang is not None and key is not None and lang.has_min_max and key.has_min_max and lang.min == lang.max and not need(lang.min, key.min, key.max):
                    continue
                for rows in file.iter_batches(TABLE_ROWS, row_groups=[g], columns=["lang", "key", "nats"]):
                    of = rows.column("lang")
                    number, keys, nats = of.indices.to_numpy(), rows.column("key").to_numpy().astype(np.uint64), rows.column("nats").to_numpy()
                    cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(number)]])
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                        if a < b:
                            piece = of.dictionary[int(number[a])].as_py(), keys[a:b], nats[a:b]
                            if keep:
                                found.append(piece)
                            yield piece
            if keep:
                self.cache[uri] = found

    def _look_up(self, files: list[str], keys: np.ndarray, codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """(nats, found) of every key: a binary search in each sorted array that can hold some."""
        want, back = np.unique(keys, return_inverse=True)
        value, found = np.zeros(len(want)), np.zeros(len(want), bool)

        def between(lang: str, first: int, last: int) -> tuple[int, int]:
            if lang not in codes:
                return 0, 0
            base = codes[lang] << int(SHIFT)
            return tuple(np.searchsorted(want, np.array([base + int(first), base + int(last) + 1], np.uint64)).tolist())

        for uri in files:
            for lang, key, nats in self._arrays(uri, lambda *r: np.diff(between(*r))[0] > 0):
                a, b = between(lang, key[0], key[-1])
                if a < b:
                    k = want[a:b] & W.U((1 << int(SHIFT)) - 1)
                    at = np.minimum(np.searchsorted(key, k), len(key) - 1)
                    hit = key[at] == k
                    value[a:b][hit], found[a:b][hit] = nats[at[hit]], True
        return value[back], found[back]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[LanguageModel, LanguageModel]:
    """The models of both orders of all languages, from all n-grams of all texts."""
    counts = materialize(count_grams(docs, text_col, lang_col), "grams")
    return LanguageModel(counts), LanguageModel(counts, LOW_ORDER)


def annotate(docs: DataFrame, models: tuple[LanguageModel, LanguageModel], text_col: str = "text", lang_col: str = "lang", prefix: str = "_q_") -> DataFrame:
    """``docs`` with the statistics of ``STATS`` and ``NLL`` (nats per byte) appended, each name
    after ``prefix``; a row-local pass over the texts."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(prefix + s, T.LongType()) for s in STATS], *[T.StructField(prefix + s, T.DoubleType()) for s in NLL]])

    def done(batch: pa.RecordBatch, stats: list, parts: list) -> pa.RecordBatch:
        stats = np.concatenate([np.zeros((0, 5), np.int64), *stats])
        nll = np.concatenate([np.zeros((0, len(NLL))), *[p.nll for p in parts]])
        cols = [pa.array(stats[:, s]) for s in range(5)] + [pa.array(x, mask=np.isnan(x)) for x in nll.T]
        return pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *[prefix + s for s in (*STATS, *NLL)]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        held, open_, size = [], [], 0
        for batch in batches:
            buf, off = W.text_bytes(batch.column(text_col))
            names, langs = _languages(batch.column(lang_col).cast(pa.string()))
            langs = np.array([codes.setdefault(x, len(codes)) for x in names], np.int64)[langs]
            held.append((batch, [], []))
            for i, j in W.chunks(off):
                b, o = buf[off[i] : off[j]], off[i : j + 1] - off[i]
                held[-1][1].append(text_stats(b, o))
                open_.append(_Part(b, o, langs[i:j]))
                held[-1][2].append(open_[-1])
                size += len(b)
                if size >= GROUP_BYTES:
                    _score(open_, models, codes)
                    open_, size = [], 0
            if not open_:
                yield from (done(*x) for x in held)
                held = []
        _score(open_, models, codes)
        for model in models:
            model.cache.clear()
        yield from (done(*x) for x in held)

    return docs.mapInArrow(workers.tidy(task), schema)


class _Part:
    """The n-grams of some rows: the distinct ones, and where each is in its row."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, langs: np.ndarray):
        self.nll = np.full((len(langs), len(NLL)), np.nan)
        row, g = grams(buf, off) if len(buf) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.n = np.bincount(row, minlength=len(langs))
        self.keys, at = np.unique(langs[row].astype(np.uint64) << SHIFT | g, return_inverse=True)
        self.at = at.astype(np.int32)


def _score(parts: list[_Part], models: tuple[LanguageModel, LanguageModel], codes: dict[str, int]) -> None:
    """Sets ``nll`` of the parts: the means over a row's n-grams, null without any."""
    need = np.unique(np.concatenate([np.zeros(0, np.uint64), *[p.keys for p in parts]]))
    low = (need >> SHIFT << SHIFT) | (need & W.U((1 << 8 * LOW_ORDER) - 1))
    few, back = np.unique(low, return_inverse=True)
    nats = models[0].nats(need, codes), models[1].nats(few, codes)[back]
    for p in parts:
        row, of = np.repeat(np.arange(len(p.n)), p.n), np.searchsorted(need, p.keys)
        for i, each in enumerate(nats):
            s = np.bincount(row, each[of][p.at], minlength=len(p.n))
            p.nll[p.n > 0, i] = s[p.n > 0] / p.n[p.n > 0]
        del p.keys, p.at


# ---------------------------------------------------------------- rules
def base_failed(prefix: str = ""):
    return (F.col(prefix + "n_words") < MIN_WORDS) | (100 * F.col(prefix + "n_repeat_words") > MAX_REPEAT_PCT * F.col(prefix + "n_words"))


def bands(stats: DataFrame, prefix: str = "", least: float = LEAST_S) -> DataFrame:
    """(band_lang, band_mid, band_s, band_mid3, band_s3): one row per language, from two map-side-combined
    quantile sketches."""
    values = [F.col(prefix + c).alias(c) for c in NLL]
    ok = stats.filter(~base_failed(prefix) & F.col(prefix + "nll").isNotNull()).select(F.coalesce(F.col("lang"), F.lit("\x00")).alias("band_lang"), *values).distinct()
    half = lambda of, what: F.percentile_approx(of, 0.5, 10000).alias(what)
    mid = ok.groupBy("band_lang").agg(half("nll", "band_mid"), half("nll3", "band_mid3"), F.count("*").alias("docs"))
    off = ok.join(_small(materialize(mid, "bands")), "band_lang").groupBy("band_lang", "docs", "band_mid", "band_mid3")
    off = off.agg(half(F.abs(F.col("nll") - F.col("band_mid")), "mad"), half(F.abs(F.col("nll3") - F.col("band_mid3")), "mad3"))
    s = lambda mad: F.greatest(1.4826 * F.col(mad), F.lit(least)) + 0.25 / F.col("docs")
    return materialize(off.select("band_lang", "band_mid", s("mad").alias("band_s"), "band_mid3", s("mad3").alias("band_s3")), "bands")


def _small(per_language: DataFrame, most: int = 10_000) -> DataFrame:
    """A table of one row per language, broadcast once its rows are counted and few."""
    return F.broadcast(per_language) if per_language.count() <= most else per_language


def judge(stats: DataFrame, band: DataFrame, prefix: str = "") -> DataFrame:
    """``stats`` with ``base_failed`` and ``kept`` (both after ``prefix``)."""
    names = {c: W.fresh(stats.columns, "_" + c) for c in band.columns}
    for old, new in names.items():
        band = band.withColumnRenamed(old, new)
    lang, mid, s, mid3, s3 = names.values()
    joined = stats.withColumn(lang, F.coalesce(F.col("lang"), F.lit("\x00"))).join(_small(band), lang, "left")
    z, z3 = (F.col(prefix + "nll") - F.col(mid)) / F.col(s), (F.col(prefix + "nll3") - F.col(mid3)) / F.col(s3)
    above = F.greatest(z, F.lit(0.0)) + F.greatest(z3, F.lit(0.0))
    inside = F.coalesce((z <= BAND) & z3.between(-LOW, BAND) & (above <= JOINT), F.lit(True))
    failed = base_failed(prefix)
    return joined.withColumn(prefix + "base_failed", failed).withColumn(prefix + "kept", ~failed & inside).drop(*names.values())


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    docs = docs.select("doc_id", "text", "lang")
    stats = materialize(annotate(docs, fit(docs), prefix="").drop("text"), "quality")
    return judge(stats, bands(stats)).select("doc_id", *STATS, "base_failed", "kept", "lang", *NLL)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that pass. The texts are scored twice, once for the bands
    and once for the verdict, and never shuffled."""
    models = fit(docs)
    p = W.fresh(docs.columns, "_q_")
    stats = materialize(annotate(docs.select("text", "lang"), models, prefix=p).drop("text"), "quality")
    judged = judge(annotate(docs, models, prefix=p), bands(stats, p), p)
    return judged.filter(p + "kept").drop(*[p + c for c in (*STATS, *NLL, "base_failed", "kept")])
