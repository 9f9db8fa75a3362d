"""Main text of generated pages of varied layouts, and attribute values that mean nothing."""

import html as entities
import random

import pytest

from tastemap.llm import htmltext
from tests.llm.conftest import clashing, words


class Page:
    """A random page and its article's text."""

    def __init__(self, rng, named=True):
        self.rng = rng
        sentence = lambda a, b: " ".join(words(rng, rng.randint(a, b)))
        self.blocks, parts = [], []

        def block(tag, text, attrs=""):
            self.blocks.append(text)
            parts.append(f"<{tag}{attrs}>{entities.escape(text)}</{tag}>" + rng.choice(["", "\n  "]))

        block("h1", sentence(3, 8))
        for _ in range(rng.randint(1, 7)):
            kind = rng.random()
            if kind < 0.6:
                block("p", sentence(12, 60), rng.choice(["", ' class="lead"', ' title="a hidden gem"', ' data-id="comment-3"']))
            elif kind < 0.7:
                block("blockquote", sentence(8, 20))
            elif kind < 0.8:
                items = [sentence(3, 9) for _ in range(3)]
                self.blocks += items
                parts.append("<ul>" + "".join(f"<li>{entities.escape(x)}" + rng.choice(["</li>", ""]) for x in items) + "</ul>")
            elif kind < 0.9:
                a, b, c = sentence(5, 9), sentence(1, 3), sentence(4, 9)
                self.blocks.append(f"{a} {b}, {c}")
                parts.append(f'<p>{entities.escape(a)} <a href="/view?id=search&amp;class=ad">{entities.escape(b)}</a>, <i>{entities.escape(c)}</i></p>')
            else:
                block("div", sentence(10, 25), ' class="form-factor text"')
            if rng.random() < 0.2:
                parts.append(rng.choice(['<div class="ad">Buy this now</div>', '<aside>More of this</aside>', "<script>var p='<p>no</p>'</script>", '<div class="promo box7">Only today</div>']))
        content = "".join(parts)
        wrap = rng.choice(["article", "main"]) if named else 'div class="post"'
        content = f"<{wrap}>{content}</{wrap.split()[0]}>"
        if rng.random() < 0.5:
            content = f'<div class="wrap"><div id="page">{content}</div></div>'
        links = "".join(f'<li><a href="/{i}">{w}</a></li>' for i, w in enumerate(words(rng, 6)))
        before = [f"<nav><ul>{links}</ul></nav>", f'<div class="cookie-notice">{sentence(4, 12)}</div>', f'<div class="teaser">{sentence(5, 15)}</div>', f'<header><p>{sentence(2, 5)}</p></header>']
        after = [f'<section id="comments"><p>{sentence(10, 60)}</p><p>{sentence(5, 30)}</p></section>', f"<footer>{sentence(4, 9)}</footer>", f'<div class="sidebar"><p>{sentence(8, 30)}</p></div>',
                 f"<form><label>{sentence(1, 3)}</label></form>"]
        rng.shuffle(before)
        rng.shuffle(after)
        self.html = f"<!doctype html><html><head><title>{sentence(2, 6)}</title></head><body>{''.join(before[: rng.randint(1, 4)])}{content}{''.join(after[: rng.randint(1, 4)])}</body></html>"
        self.text = "\n".join(" ".join(b.split()) for b in self.blocks)


@pytest.fixture(scope="module")
def weights(spark):
    rng = random.Random(7)
    rows = [(i, "u", Page(rng).html) for i in range(400)]
    return htmltext.fit(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4))


def test_named_content_of_unseen_pages(weights):
    rng = random.Random(8)
    pages = [Page(rng) for _ in range(300)]
    assert sum(htmltext.extract(p.html, weights) == p.text for p in pages) >= 0.97 * len(pages)


def test_unnamed_content_of_unseen_pages(weights):
    """Pages without ``article`` or ``main``: nearly all words of the text, and hardly any others."""
    rng = random.Random(9)
    kept = missed = wrong = 0
    for _ in range(200):
        p = Page(rng, named=False)
        got, want = htmltext.extract(p.html, weights).split(), p.text.split()
        rest = list(want)
        for w in got:
            if w in rest:
                rest.remove(w)
            else:
                wrong += 1
        kept, missed = kept + len(want) - len(rest), missed + len(rest)
    assert missed < 0.05 * (kept + missed) and wrong < 0.1 * kept


def test_classes_beside_the_content_are_learned(weights):
    assert "div.teaser" in weights.apart  # in no word list
    assert not {"div.wrap", "div.post", "p.lead", "div.text"} & weights.apart
    assert all(w < 0 for w in weights.tags.values()) and weights.words[htmltext.NAMED] > 0.9


def page(inner, rest=""):
    return f'<html><head><title>t</title></head><body><nav><a href="/x">m</a></nav>{rest}<article><h1>Title</h1>{inner}</article><footer>c</footer></body></html>'


@pytest.mark.parametrize(
    "inner, text",
    [
        ('<p><a href="/view?id=search">link text</a> more</p>', "link text more"),
        ('<p title="a hidden gem">gem text</p>', "gem text"),
        ('<p data-id="comment-3">some text</p>', "some text"),
        ('<div class="form-factor">factor text</div>', "factor text"),
        ("<p class=ad>gone</p><p>here</p>", "here"),
        ('<p class="big Ad-Banner">gone</p><p>here</p>', "here"),
        ('<p hidden>gone</p><p style="color: red; display:none">gone</p><p aria-hidden="true">gone</p><p>here</p>', "here"),
        ('<p id=\'comment-3\'>gone</p><p data-x="class=ad">here</p>', "here"),
    ],
)
def test_attributes(weights, inner, text):
    assert htmltext.extract(page(inner), weights) == f"Title\n{text}"


def test_short_article_beside_long_unmarked_text(weights):
    short = "one two three four five six seven eight nine ten"
    assert htmltext.extract(page(f"<p>{short}</p>", "<div>" + "x y " * 30 + "</div>"), weights) == f"Title\n{short}"


def test_weights_do_not_depend_on_partitions_and_no_labels_do(spark, weights):
    rng = random.Random(7)
    rows = [(i, "u", Page(rng).html) for i in range(400)]
    again = htmltext.fit(clashing(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(9))
    assert again == weights
    none = htmltext.fit(spark.createDataFrame([(1, "u", "<p>no label</p>"), (2, "u", None)], "page_id long, url string, html string"))
    assert none.tags == {} and htmltext.extract("<p>a b</p>", none) == "a b"
