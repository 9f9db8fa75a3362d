"""Main text of web pages by maximum-scoring subsequence.

A page becomes a sequence of tokens. Words score positive, tags negative, both by weights from
labelled pages: pages whose markup names the content (one ``article`` or ``main`` element) say which
tokens lie inside it and which outside. A word in named content weighs 1; on a page that names its content, any
other word weighs the share that labelled pages have inside of words in such a container; on a page that
doesn't, all words weigh 1. The weight of a tag is the least of its
features' weights, its name and each (name, class): one that is as common inside as outside (or stands in
named content) costs little, one that is seen outside only costs much; one scale for all tag weights is
chosen by agreement with the labels when the naming tags are taken for plain ones. One linear scan then finds the contiguous region with the largest sum.

Left out of the region, and neutral in the scan so that an advert between two paragraphs doesn't cut
it: elements whose name says that they are no main text (menus, headers, footers, sidebars, forms,
scripts, styles), hidden ones, ones with a (name, class) that labelled pages show beside the content only
(``Weights.apart``), and ones whose class, id or role is one of ``MARKS`` (all parts of a token such as
``ad-banner`` have to be, so ``form-factor`` is none). Attributes are parsed; other attributes' values
mean nothing.

The weights are fitted on about ``FIT_PAGES`` labelled pages (a documented bound: the ones whose hash is
under a threshold). Tasks count the tokens of their sampled pages and Spark adds the counts up; the
driver gets at most ``MAX_FEATURES`` counts and no page. The extraction itself reads every page whole, row
by row, without a shuffle.

Defined cases: null or empty html, and a page without words, give an empty text; a container tag
that no labelled page shows weighs ``DEFAULT_TAG``, any other such tag ``LEAST_TAG``, a word in such a
container ``LEAST_WORD`` on a page that names its content; unclosed and stray tags are tolerated; rows that repeat a page are extracted one
by one; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_PAGES = 2000
SCALES = (30.0, 10.0, 3.0, 1.0, 0.3, 0.1)  # of equally good ones, the first
DEFAULT_TAG = -2.0  # of containers no labelled page shows
LEAST_TAG = -0.01
LEAST_WORD = 0.02
NAMED = "@article"  # the container of whatever stands in an ``article`` or ``main`` element
MAX_FEATURES = 20_000
#: A (name, class) is apart if no such element holds content, and at least so many lie beside it, so many
#: times as many as inside.
APART, APART_TIMES = 5, 4

# HTML element names by their role.
NEVER = frozenset("head script style noscript template nav header footer aside form button select textarea iframe object svg canvas dialog menu".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul caption".split()
)
CONTAINERS = frozenset("html body div section main article center address details fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an opening tag of the key closes an open element of the values
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Words in ``class``, ``id`` or ``role`` that mark an element as something else than main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toc "
    "header masthead topbar footer colophon copyright sidebar sidebars aside widget widgets complementary contentinfo "
    "notice notices cookie cookies consent gdpr alert popup modal overlay disclaimer newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations trending "
    "comment comments commentlist respond disqus discussion replies reply search form forms hidden skip".split()
)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PART = re.compile(r"[^-_0-9]+")
NAMING = re.compile(r"(</?)(?:article|main)(?=[\s>])", re.I)
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)


def attributes(text: str) -> dict[str, str]:
    """Names in lower case, and their values; the first of equal names."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _marked(attrs: dict[str, str]) -> bool:
    """Hidden, or named as something else than main text."""
    if "hidden" in attrs or attrs.get("aria-hidden", "").strip().lower() == "true" or NO_DISPLAY.search(attrs.get("style", "")):
        return True
    for name in ("class", "id", "role"):
        for token in attrs.get(name, "").lower().split():
            parts = PART.findall(token)
            if parts and all(p in MARKS for p in parts):
                return True
    return False


class Token(NamedTuple):
    name: str  # tag name, with "/" for an end tag; "" for text
    text: str
    excluded: bool
    features: tuple[str, ...]  # of a tag: its name and (name, class)es
    container: str  # the element it stands in: "@article" anywhere in named content


def _container(name: str, above: str) -> str:
    if name in ("article", "main") or above == NAMED:
        return NAMED
    return f"@{name}" if name in CONTAINERS or name in ("td", "li", "blockquote") else above


def tokens(page: str, apart: frozenset[str] = frozenset()) -> list[Token]:
    """The tokens of a page in order. Elements with a feature in ``apart`` are excluded, too."""
    out: list[Token] = []
    open_: list[tuple[str, tuple[str, ...], str]] = []  # name, features, container
    shut = 0  # depth of the outermost excluded element, 0: none
    at, n = 0, len(page)

    def text(s: str) -> None:
        if s:
            out.append(Token("", entities.unescape(s), shut > 0, (), here()))

    def here() -> str:
        return open_[-1][2] if open_ else "@"

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        end, raw = bool(m[1] or m[4]), m[3] or m[6] or ""
        if end:
            features = (name,)
            if any(o[0] == name for o in open_):
                while True:
                    last, features, _ = open_.pop()
                    if last == name:
                        break
                if len(open_) < shut:
                    shut = 0
                    out.append(Token("/" + name, "", True, features, here()))
                    continue
            out.append(Token("/" + name, "", shut > 0, features, here()))
            continue
        if (name == "p" or (name in BLOCK and name != "body")) and open_ and open_[-1][0] == "p":
            open_.pop()
        for other in CLOSES.get(name, ()):
            if open_ and open_[-1][0] == other:
                open_.pop()
        if len(open_) < shut:
            shut = 0
        attrs = attributes(raw) if raw.strip(" /") else {}
        features = (name, *dict.fromkeys(f"{name}.{c}" for c in attrs.get("class", "").lower().split()))
        if name in VOID or raw.endswith("/"):
            out.append(Token(name, "", shut > 0, features, here()))
            continue
        open_.append((name, features, _container(name, here())))
        if not shut and (name in NEVER or (name not in ("html", "body", "article", "main") and (_marked(attrs) or not apart.isdisjoint(features)))):
            shut = len(open_)
        out.append(Token(name, "", shut > 0, features, here()))
        if name in RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if name == "title" or name == "textarea":
                text(page[at : stop.start() if stop else n])
            at = stop.end() if stop else n
            open_.pop()
            if len(open_) < shut:
                shut = 0
    return out


@dataclass(frozen=True)
class Weights:
    """Of tag features (negative) and of words by container (positive; on pages that name their content);
    the (name, class)es that are apart."""

    tags: dict[str, float]
    words: dict[str, float]
    apart: frozenset[str] = frozenset()

    def score(self, t: Token, named: bool) -> float:
        if t.excluded:
            return 0.0
        if not t.name:
            share = self.words.get(t.container, self.words.get("@", LEAST_WORD)) if named and t.container != NAMED else 1.0
            return len(t.text.split()) * share
        if t.container == NAMED:  # all such tags of labelled pages lie inside
            return LEAST_TAG
        known = [self.tags[f] for f in t.features if f in self.tags]
        return min(known) if known else DEFAULT_TAG if t.name.lstrip("/") in CONTAINERS else LEAST_TAG


def region(toks: list[Token], weights: Weights) -> tuple[int, int]:
    """[start, end) of the contiguous tokens with the largest sum: one scan, first of equals."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    named = any(t.container == NAMED and not t.name and not t.excluded and t.text.strip() for t in toks)
    for i, t in enumerate(toks):
        total += weights.score(t, named)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def blocks(toks: list[Token]) -> str:
    """Text of the tokens: white space folded inside a block, blocks joined by a line feed."""
    out, here = [], []
    for t in toks:
        if t.name:
            if t.name.lstrip("/") in BLOCK:
                out.append("".join(here))
                here = []
            elif t.name == "br":
                here.append(" ")
        elif not t.excluded:
            here.append(t.text)
    out.append("".join(here))
    return "\n".join(b for b in (" ".join(x.split()) for x in out) if b)


def extract(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    toks = tokens(page, weights.apart)
    i, j = region(toks, weights)
    return blocks(toks[i:j])


# ---------------------------------------------------------------- weights
def label(page: str, apart: frozenset[str] = frozenset()) -> tuple[list[Token], int, int] | None:
    """(tokens, start, end) of the one ``article`` (else ``main``) element's inside; None without one."""
    toks = tokens(page, apart)
    for name in ("article", "main"):
        a = [i for i, t in enumerate(toks) if t.name == name]
        b = [i for i, t in enumerate(toks) if t.name == "/" + name]
        if len(a) == len(b) == 1 and a[0] < b[0]:
            return toks, a[0] + 1, b[0]
    return None


#: Places of a token on a labelled page.
INSIDE, BESIDE, AROUND = 0, 1, 2


def count(page: str) -> Counter:
    """(feature, place): how often. Tags count once each way; of elements, the start tag tells whether the
    content lies inside it (``AROUND``); words count by their container."""
    labelled, found = label(page), Counter()
    if not labelled:
        return found
    toks, i, j = labelled
    depth: list[tuple[str, int]] = []
    around = set()
    for k, t in enumerate(toks[:i]):  # what is open where the content begins holds it
        if t.name.startswith("/"):
            while depth and depth.pop()[0] != t.name[1:]:
                pass
        elif t.name and t.name not in VOID:
            depth.append((t.name, k))
    around.update(k for _, k in depth)
    for k, t in enumerate(toks):
        place = INSIDE if i <= k < j else AROUND if k in around else BESIDE
        if not t.name:
            if not t.excluded:
                found[t.container, min(place, BESIDE)] += len(t.text.split())
        elif not t.excluded or "." in "".join(t.features):
            for f in t.features:
                if not t.excluded or "." in f:
                    found[f, place] += 1
    return found


def _weights(counts: dict[tuple[str, int], int], scale: float) -> Weights:
    get = lambda f, *places: sum(counts.get((f, p), 0) for p in places)
    features = {f for f, _ in counts}
    apart = frozenset(
        f for f in features if "." in f and not get(f, AROUND) and get(f, BESIDE) >= APART and get(f, BESIDE) >= APART_TIMES * get(f, INSIDE)
    )
    tags, words = {}, {}
    for f in features:
        inside, outside = get(f, INSIDE), get(f, BESIDE, AROUND)
        if f.startswith("@"):
            words[f] = max(LEAST_WORD, inside / (inside + outside + 1.0))
        else:
            odds = math.log((inside + 0.5) / (outside + 0.5))
            tags[f] = odds * scale if odds < LEAST_TAG else LEAST_TAG
    return Weights(tags, words, apart)


def agreement(page: str, i: int, j: int, weights: Weights) -> int:
    """Words that the scan finds right, less those it finds wrongly, when the page doesn't name its
    content: the tokens from i to j of the page with the naming elements as ``div``."""
    toks = tokens(NAMING.sub(r"\1div", page), weights.apart)
    a, b = region(toks, weights)
    return sum(len(t.text.split()) * (1 if i <= k < j else -1) for k, t in enumerate(toks[a:b], a) if not t.name and not t.excluded)


def _sampled(pages: DataFrame, html: Column, fit_pages: int) -> DataFrame:
    """About ``fit_pages`` of the pages with an ``article`` or ``main`` tag: the hashes under a threshold."""
    able = pages.filter(html.rlike(r"(?i)<(article|main)[\s>]")).select(html.alias("html"))
    n = able.count()
    if n <= fit_pages:
        return able
    return able.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 40)) < F.lit(int((1 << 40) * fit_pages / n)))


def fit(pages: DataFrame, html_col: str = "html", fit_pages: int = FIT_PAGES) -> Weights:
    """Weights from about ``fit_pages`` labelled pages, counted in tasks."""
    sample = _sampled(pages, F.col(html_col), fit_pages)

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for x in batch.column("html"):
                total.update(count(x.as_py()))
        rows = list(total.items())
        yield pa.record_batch({"feature": pa.array([f for (f, _), _ in rows], pa.string()), "place": pa.array([p for (_, p), _ in rows], pa.int32()), "n": pa.array([n for _, n in rows], pa.int64())})

    per = sample.mapInArrow(counting, "feature string, place int, n long").groupBy("feature", "place").agg(F.sum("n").alias("n"))
    counts = {(r["feature"], r["place"]): r["n"] for r in per.orderBy(F.col("n").desc(), "feature", "place").limit(MAX_FEATURES).collect()}
    choices = [_weights(counts, s) for s in SCALES]

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros(len(choices), np.int64)
        for batch in batches:
            for x in batch.column("html"):
                labelled = label(x.as_py())
                if labelled:
                    right += [agreement(x.as_py(), *labelled[1:], w) for w in choices]
        yield pa.record_batch({"choice": pa.array(np.arange(len(choices))), "n": pa.array(right)})

    agreed = {r["choice"]: r["n"] for r in sample.mapInArrow(agreeing, "choice long, n long").groupBy("choice").agg(F.sum("n").alias("n")).collect()}
    return max(enumerate(choices), key=lambda c: (agreed.get(c[0], 0), -c[0]))[1]


def add_text(pages: DataFrame, weights: Weights, html_col: str = "html", out_col: str = "_text") -> DataFrame:
    """``pages`` (all columns) with the main text appended."""
    schema = T.StructType([*pages.schema.fields, T.StructField(out_col, T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([extract(x.as_py(), weights) for x in batch.column(html_col)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, out_col])

    return pages.mapInArrow(task, schema)


def report(pages: DataFrame) -> DataFrame:
    """The query's columns."""
    pages = pages.select("page_id", "url", "html")
    out = add_text(pages, fit(pages))
    return out.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
