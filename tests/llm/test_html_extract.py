"""Blocks of hand-written pages; the CRF on designs it has not seen."""

import html
import random
import re
import time

import numpy as np
import pytest

from reelrank.llm import html_extract
from reelrank.llm.html_blocks import blocks
from reelrank.llm.html_extract import Crf, distant_label, redesign, train


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize("page,want", [
    (None, []), ("", []), ("  \n ", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p>a<b>b</b>c</p>", ["abc"]),
    ("<p>a &amp;&nbsp; b&#33;</p>", ["a & b!"]), ("<p>x\n\t y<br>z</p>", ["x y z"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<p>a<script>var t='</p>';</script>b</p>", ["ab"]), ("<style>p{}</style><p>a", ["a"]), ("<script>never closed <p>a", []),
    ("<!-- <p>no</p> --><p>a</p><!-- open", ["a"]), ("a < b and c > d", ["a < b and c > d"]), ("<p title='a>b'>x</p>", ["x"]),
    ("<p>a</div>b</p>", ["a", "b"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]), ("<p><b>x.<br><p>y</p>", ["x.", "y"]),
    ("<title>t</title><body>a", ["a"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<P CLASS=Ad>X</P>", ["X"]),
    ("&lt;p&gt;", ["<p>"]), ("<p>" + "w " * 100_000 + "</p>", [("w " * 100_000).strip()]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_features_tell_ancestors_and_names():
    (block,) = blocks('<div id="Side-Bar" class="x"><nav><a href="#">Home</a></nav></div>')
    assert {"in:nav", "in:div", "name:side", "name:bar", "tag:nav", "linked:3"} <= set(block.features)
    assert distant_label(blocks("<article><p>a</p></article>")[0].ancestors)
    assert not distant_label(blocks('<article><div class="comments">a</div></article>')[0].ancestors)
    assert not distant_label(blocks("<p>a</p>")[0].ancestors)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 7))
        model = Crf({str(i): float(w) for i, w in enumerate(rng.normal(size=8))}, rng.normal(size=2), rng.normal(size=(2, 2)))
        rows = [[str(x) for x in rng.integers(0, 8, 3)] for _ in range(n)]

        def score(path):
            s = model.start[path[0]] + sum(model.move[a, b] for a, b in zip(path, path[1:]))
            return s + sum(sum(model.weights[f] for f in fs) for fs, y in zip(rows, path) if y)
        best = max((tuple(int(b) for b in f"{k:0{n}b}") for k in range(1 << n)), key=score)
        assert score(tuple(int(x) for x in model.labels(rows))) == pytest.approx(score(best))
    assert Crf({}, np.zeros(2), np.zeros((2, 2))).labels([]) == []


def test_training_fits_a_chain_and_handles_nothing():
    pages = [[(["a"], True), (["b"], True), (["c"], False)], [(["c"], False), (["a"], True)], []] * 5
    model = train(pages)
    assert model.labels([["a"], ["b"], ["c"]]) == [True, True, False]
    assert train([]).labels([["in:article", "bias"], ["bias"]]) == [True, False]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return html_extract.fit(pages, sample=120)


def test_given_pages(pages, model):
    rows = {r["page_id"]: r for r in pages.collect()}
    for r in html_extract.extract(pages, model).collect():
        article = re.search(r"<article>(.*?)</article>", rows[r["page_id"]]["html"], re.S)[1]
        want = " ".join(" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", article) if x.strip())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_unseen_designs(pages, model, sentence):
    rng, wrong, total = random.Random(77), 0, 0
    for i in range(150):
        content = [sentence(1000 * i + k, rng.randint(1, 60)).capitalize() + "." for k in range(rng.randint(1, 12))]
        other = [sentence(50_000 + 10 * i + k, rng.randint(1, 6)) for k in range(6)]
        rows = redesign(content, other, rng)
        got = model.labels([f for f, _ in rows])
        total += len(rows)
        wrong += sum(g != y for g, (_, y) in zip(got, rows))
    assert wrong / total < 0.02


def test_hand_written_page(model):
    page = """<html><head><title>T</title></head><body><header class="site-header"><a href="/">My site</a></header>
    <div class="cookie-banner">We use cookies on this site.</div><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
    <main><div class="post-content"><h1>A title of the story</h1><p>The first paragraph of the story is long enough to read.</p>
    <div class="advertisement">Buy now!</div><p>The second paragraph &amp; the end of it, with <b>bold</b> words.</p></div>
    <section class="comments"><h3>Comments</h3><p>Nice story, I liked it a lot.</p></section></main>
    <aside class="sidebar"><p>Popular posts of the week</p></aside><form><label>Search</label><input></form>
    <footer>&copy; 2024 My site</footer></body></html>"""
    found = blocks(page)
    kept = [b.text for b, y in zip(found, model.labels([b.features for b in found])) if y]
    assert kept == ["A title of the story", "The first paragraph of the story is long enough to read.",
                    "The second paragraph & the end of it, with bold words."]


def test_odd_tables(spark, model):
    page = "<article><p>x y</p></article>"
    rows = [(1, "u", page, "a"), (1, "u", page, "a"), (None, None, None, "b"), (2, "v", "", "c")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(tuple(r)[:4] for r in html_extract.extract(docs, model).na.fill(-1, ["page_id"]).na.fill("", ["url"]).collect())
    assert got == [(-1, "", "", 0), (1, "u", "x y", 3), (1, "u", "x y", 3), (2, "v", "", 0)]
    empty = docs.limit(0)
    assert html_extract.extract(empty, html_extract.fit(empty)).count() == 0


@pytest.mark.parametrize("page,want", [
    ('<p>a<svg class="i"/>b</p><p>c', ["ab", "c"]), ('<svg class="i"/><p>a</p><svg><text>no</text></svg><p>b', ["a", "b"]),
    ('<svg class="i"><p>a</p>', ["a"]), ("<object data=x><p>a", ["a"]), ("<template><p>no</template><p>a", ["a"]),
])
def test_only_raw_text_runs_to_the_end(page, want):
    assert texts(page) == want


def test_one_page_for_each_sampled_key(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(html_extract, "train", lambda pages: seen.append(len(pages)))
    pages = [(None, None, f"<article><p>text {i}</p></article>") for i in range(30)]
    html_extract.fit(spark.createDataFrame(pages, "page_id long, url string, html string"), sample=5, designs=1)
    assert seen == [2]


@pytest.mark.parametrize("page,want", [
    ("<a href=\"x <p>a", ["a"]), ("<a href=\"x <p>a > b", ["a > b"]), ("a <b", ["a <b"]), ("<p>a<scriptx>b", ["a", "b"]),
    ("<p>a<script", ["a"]), ("<svg/><p>a", ["a"]), ("<svg>x</svg><svg>y", ["y"]), ("<p title='<b>'>a<br/>b", ["a b"]),
    ("&#" + "0" * 5000 + "65;", ["A"]), ("&#" + "9" * 5000 + ";x", ["�x"]), ("&#0065", ["A"]), ("<!x", ["<!x"]),
    ("<b><p>a</b>b</p>c", ["a", "b", "c"]), ("<p><i>a<div>b</div>c", ["a", "b", "c"]),
])
def test_markup_that_does_not_end(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("unit", [
    "<svg>x", "<div>x ", '<a href="x ', "<a ", "<b>x<hr>", "<a<a", "<", "<!", '"<a ">', "<template>", "</p ", "<script",
    "'\"<a '\">", "<p><b>x", "<li><ul>x", '<x y="<', "</b>", "&#0", "<td>x", "<svg ", "<select><option>",
])
def test_hostile_pages_take_linear_time(unit):
    """A page of 1 MB of each kind, whole and with tags that end at its end."""
    for end in ("", '">', "'>"):
        begin = time.process_time()
        blocks(unit * (1_000_000 // len(unit)) + end, frozenset(["in:div"]))
        assert time.process_time() - begin < 10


def test_many_features_of_ancestors_are_kept_once():
    names = ["".join(chr(97 + int(d)) for d in str(i)) for i in range(20_000)]
    page = "".join(f'<div class="{n}">x' for n in names)
    found = blocks(page, frozenset(["name:b", "in:div"]))
    assert len(found) == 20_000 and found[-1].ancestors == ("in:div", "name:b")


def test_features_do_not_depend_on_the_known_ones():
    page = '<main id=story><nav class="menu x">a</nav><p class="x">b</p><footer>c</footer></main>'
    for whole, few in zip(blocks(page), blocks(page, frozenset(["name:x", "in:main"]))):
        assert few.ancestors == tuple(f for f in whole.ancestors if f in ("name:x", "in:main"))
        assert few.text == whole.text and set(few.features) <= set(whole.features)
