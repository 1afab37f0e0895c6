import os
import random
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from helpers import as_tables

from barloom.llm import html_text, queries
from barloom.llm.html_blocks import Block, blocks

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy now</div><article><h1>{0}</h1><p><b>{1}<br><p>{2}</p></article><footer>&copy; some site</footer></body></html>"""


def texts(rng, n):
    return [" ".join(rng.choice(["one", "two", "sea", "land", "tree", "stone"]) for _ in range(rng.randint(8, 40))) + "." for _ in range(n)]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def paths(page):
    return [(b.path[-1] if b.path else "", b.text) for b in blocks(page)]


def test_blocks():
    assert paths("<p>a<p>b &amp; <b>c</b>d<br>e</p>f") == [("p", "a"), ("p", "b & cd"), ("p", "e"), ("", "f")]
    assert paths("<ul><li>a<li>b<ul><li>c</ul></ul>t") == [("li", "a"), ("li", "b"), ("li", "c"), ("", "t")]
    assert paths("<script>if (a<b) '</p>'</script>x<style>y") == [("", "x")]
    assert paths("a < b &lt;p&gt; <3 <!-- c --> d<!-- e") == [("", "a < b <p> <3 d")]
    assert paths("</div></p>x<div><p>y</div>z") == [("", "x"), ("p", "y"), ("", "z")]
    assert paths("<P CLASS='Big Red' id=top>  a \n\t b<") == [(".top", "a b<")]
    assert paths("<td><p>a<table><tr><td>b</table>c") == [("p", "a"), ("td", "b"), ("td", "c")]
    assert blocks(None) == blocks("") == blocks("<p> <br></p>") == []


def test_nothing_but_hidden_elements_is_dropped():
    for mark in ("<svg class='i'/>", "<svg class='i' />", "<SVG/>", "<svg>", "<template>", "<noscript>", "<noscript></noscript>"):
        assert " ".join(x for _, x in paths(f"<p>a {mark}b</p><p>c</p>")) == "a b c", mark
        if "noscript" not in mark:
            assert paths(f"<p>a {mark}b</p><p>c <svg><text>no</text></svg>d</p>") == [("p", "a b"), ("p", "c d")], mark
    assert paths("<p>a<svg><svg><text>no</text></svg><svg/>no</svg>b<template><p>no<template>no</template>no</template>c") == [("p", "abc")]
    assert paths("<p>a<svg><!-- </svg> --><style>x{}</svg></style>no</svg>b") == [("p", "ab")]
    assert paths("<svg><template>no</template>a<p>b</svg>") == [] and paths("<template>a<svg>no</svg><p>b") == [("", "a"), ("p", "b")]
    assert paths("<p>a<script>b</p>") == [("p", "a")]
    found = blocks("<article><p>a <noscript>b <img src='x'></noscript>c</p><noscript><p>d</p></noscript></article>")
    assert [b.text for b in found] == ["a", "b", "c", "d"]
    assert found[0].path == found[2].path == ("article", "p") and "noscript" in found[1].path


def test_many_open_elements_in_linear_time():
    start = time.process_time()
    assert [b.text for b in blocks("<svg><template>a " * 50_000)] == ["a " * 49_999 + "a"]
    assert time.process_time() - start < 10


def test_gradients_are_the_slopes_of_the_loss():
    rng = np.random.default_rng(0)
    net = html_text.Network.fresh(rng)
    given = [rng.standard_normal((n, html_text.INPUTS)) for n in (1, 4, 6)]
    labels = [(rng.random(len(p)) < 0.5).astype(float) for p in given]
    slopes, _ = html_text._gradients(net, given, labels)
    for weights, slope in zip((net.forward, net.backward, net.out), slopes, strict=True):
        for _ in range(6):
            at = tuple(int(rng.integers(n)) for n in weights.shape)
            old, losses = weights[at], []
            for step in (1e-5, -1e-5):
                weights[at] = old + step
                losses.append(html_text._gradients(net, given, labels)[1])
            weights[at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - slope[at]) < 1e-6


def test_batching_does_not_change_labels():
    rng = np.random.default_rng(1)
    net = html_text.Network.fresh(rng)
    given = [rng.standard_normal((n, html_text.INPUTS)) for n in (3, 0, 1, 9, 3)]
    for one, many in zip([net.label([p])[0] for p in given], net.label(given), strict=True):
        np.testing.assert_allclose(one, many, atol=1e-12)


@pytest.fixture(scope="module")
def trained():
    rng = random.Random(5)
    return html_text.train(html_text.examples([PAGE.format(*texts(rng, 3)) for _ in range(60)]))


def wrong_pages(net, made):
    wrong = 0
    for page in made:
        found = blocks(page)
        labels = np.array([html_text.MARK in b.text for b in found])
        for b in found:
            b.text = b.text.replace(html_text.MARK, "") or "text"
        wrong += bool(((net.label([html_text.features(found)])[0] >= 0.5) != labels).any())
    return wrong


def test_held_out_layouts(trained):
    rng = random.Random(6)
    made = [html_text.layout(rng, texts(rng, rng.randint(1, 8)), texts(rng, 20)) for _ in range(200)]
    assert wrong_pages(trained, made) <= 20


def test_other_parts_of_pages_are_left_out(trained):
    rng = random.Random(7)
    a, b, c, d = texts(rng, 4)
    page = (
        f"<html><body><header><a href='/'>Site</a></header><div class='cookie-notice'><p>{d}</p><button>OK</button></div>"
        f"<main><h1>{a}</h1><p>{b}</p><p>{c}</p></main><section class='comments'><p>{d}</p><p>{a}</p></section>"
        f"<aside class='sidebar'><ul><li><a href='/x'>more</a></li></ul></aside><form><label>Mail</label></form><footer>legal</footer>"
    )
    found = blocks(page)
    chosen = [b.text for b, p in zip(found, trained.label([html_text.features(found)])[0], strict=True) if p >= 0.5]
    assert chosen == [a, b, c]


def test_text_without_scripts_is_judged(trained):
    rng = random.Random(10)
    right = 0
    for _ in range(100):
        a, b, c, d = texts(rng, 4)
        page = f"<html><body><nav><a href='/'>x</a></nav><noscript>{d}</noscript><article><h1>{a}</h1><p>{b}</p><noscript>{c}</noscript></article>"
        found = blocks(page)
        right += [x.text for x, p in zip(found, trained.label([html_text.features(found)])[0], strict=True) if p >= 0.5] == [a, b, c]
    assert right >= 90


def test_all_words_of_a_block_count():
    start = ["sea"] * 64
    one, other, twice = (
        html_text.features([Block(("p",), " ".join(words), 0)])[0, html_text.PATH_DIMS : html_text.PATH_DIMS + html_text.WORD_DIMS]
        for words in (start + ["land"] * 300, start + ["tree"] * 300, (start + ["land"] * 300) * 2)
    )
    assert np.abs(one - other).max() > 0.5
    np.testing.assert_allclose(one, twice)
    assert abs(one.sum() - 1) < 1e-12


def long_page(rng):
    """A page whose article is one long block, between other long blocks, and the article's text."""
    menu, article, comment, legal = (" ".join(texts(rng, n)) for n in (1, 20, 12, 16))
    return (
        f"<html><body><nav><ul><li><a href='/a'>{menu[:12]}</a></li></ul></nav><article><p>{article}</p></article>"
        f"<section class='comments'><p>{comment}</p></section><footer><p>{legal}</p></footer></body></html>"
    ), article


def test_long_blocks(trained):
    rng = random.Random(9)
    right = 0
    for _ in range(100):
        page, article = long_page(rng)
        found = blocks(page)
        chosen = [b.text for b, p in zip(found, trained.label([html_text.features(found)])[0], strict=True) if p >= 0.5]
        assert len(article.split()) > 200
        right += chosen == [article]
    assert right >= 95


def test_query_on_odd_rows(spark, monkeypatch):
    rng = random.Random(8)
    made = [texts(rng, 3) for _ in range(40)]
    rows = [(i, f"u{i}", PAGE.format(*t)) for i, t in enumerate(made)]
    odd = [(100, None, None), (None, "u", ""), (101, "u", "<p>"), (102, "u", ""), (0, "u0", rows[0][2])]
    as_tables(monkeypatch, queries, pages=pages(spark, rows + odd))
    got = queries.op7_html_text(spark, "").collect()
    assert len(got) == 45 and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert all(by_id[i] == " ".join(t) for i, t in enumerate(made))
    assert by_id[100] == by_id[None] == by_id[101] == ""
    as_tables(monkeypatch, queries, pages=pages(spark, []))
    assert queries.op7_html_text(spark, "").collect() == []


def test_columns_of_the_same_names(spark):
    frame = pages(spark, [(1, "u", "<p>x")]).selectExpr("*", "1 as text", "2 as n_chars", "3 as other")
    net = html_text.Network.fresh(np.random.default_rng(0))
    assert html_text.extract(frame, net).columns == ["page_id", "url", "html", "other", "text", "n_chars"]


def test_long_pages_alone_or_in_a_run_are_labelled_alike(monkeypatch):
    net = html_text.Network.fresh(np.random.default_rng(5))
    page = blocks("".join(f"<div class=c{i % 7}><p>word {i} and more</p></div>" for i in range(500)))
    short = [blocks(f"<p>one {i}<p>two") for i in range(30)]
    together = net.label([html_text.features(p) for p in [page, *short]])
    monkeypatch.setattr(html_text, "STRETCH", 64)
    monkeypatch.setattr(html_text, "PLACES", 10)
    for one, other in zip(together, net.label_blocks([page, *short]), strict=True):
        assert np.allclose(one, other, atol=1e-12)
    assert [len(x) for x in net.label_blocks([[], page, []])] == [0, 500, 0]


def test_memory_of_a_page_with_very_many_blocks():
    """170,000 short blocks beside 50 small pages, in less than 2 GB."""
    code = (
        "import resource; resource.setrlimit(resource.RLIMIT_AS, (2 << 30, 2 << 30));"
        "import numpy as np; from barloom.llm import html_text; from barloom.llm.html_blocks import blocks;"
        "net = html_text.Network.fresh(np.random.default_rng(1));"
        "found = [blocks('<p>a' * 170_000)] + [blocks('<p>b<p>c')] * 50;"
        "assert [len(x) for x in net.label_blocks(found)] == [170_000] + [2] * 50"
    )
    root = Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env={**os.environ, "OPENBLAS_NUM_THREADS": "1", "OMP_NUM_THREADS": "1"})


def test_a_slash_closes_drawings_only():
    assert [(b.text, b.linked) for b in blocks("<a href=/x/>one two</a> three")] == [("one two three", 2)]
    assert paths("<div class=sidebar/>x</div>y") == [(".sidebar", "x"), ("", "y")]
    assert paths("<div class='ad'/>x<p/>y") == [(".ad", "x"), ("p", "y")]
    assert paths("<svg/>x<svg class='i'/>y<svg d=a/>z</svg>w") == [("", "xyw")]
