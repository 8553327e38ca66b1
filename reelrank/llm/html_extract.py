"""Main-text extraction: a linear-chain CRF over the leaf blocks of a page.

Two labels, content and boilerplate. Emissions are sums of weights of ancestor
tags, class and id names, and text features; transitions are weights of label
pairs. Training maximises the regularised conditional likelihood of labelled
pages; decoding is Viterbi.

Labelled pages come from the pages themselves, a bounded sample: blocks of an
``<article>`` outside its asides are content, all others are boilerplate. So
that the model knows more than one site design, the labelled blocks of each
sampled page are also set in other designs (:func:`redesign`): other containers
for the article, and menus, notices, adverts, forms, sidebars and comments, with
the usual names, around and inside it.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise
from reelrank.llm.html_blocks import blocks

#: Pages that the fit reads at most, designs made of each, and blocks of one
#: design that training looks at (extraction reads every block).
SAMPLE, DESIGNS, TRAIN_BLOCKS = 200, 4, 60
PENALTY, ROUNDS = 0.3, 100

_CONTENT = [("article", ""), ("main", ""), ("div", "content"), ("div", "main-content"), ("div", "post"),
            ("div", "post-content"), ("div", "entry-content"), ("div", "article-body"), ("section", "article"),
            ("section", "story"), ("div", "story-body"), ("div", "text"), ("td", "content"), ("div", "page-content"),
            ("article", "post"), ("div", "article"), ("main", "main"), ("div", "body"), ("div", "entry")]
#: Boilerplate: (tag, names, kind of filling, where it may stand: o outside, i inside the article as well).
_BOILERPLATE = [
    ("nav", "", "links", "o"), ("nav", "navbar menu", "links", "o"), ("div", "nav", "links", "o"),
    ("div", "menu", "links", "o"), ("ul", "menu navigation", "links", "o"), ("div", "breadcrumb", "links", "oi"),
    ("div", "breadcrumbs", "links", "oi"), ("header", "", "title", "o"), ("header", "site-header", "title", "o"),
    ("div", "header", "title", "o"), ("div", "masthead banner", "title", "o"), ("div", "topbar", "links", "o"),
    ("footer", "", "foot", "o"), ("footer", "site-footer", "foot", "o"), ("div", "footer", "foot", "o"),
    ("div", "copyright", "foot", "o"), ("div", "legal", "foot", "o"),
    ("aside", "", "text", "oi"), ("aside", "sidebar", "links", "o"), ("div", "sidebar", "text", "o"),
    ("div", "widget", "links", "o"), ("div", "related", "links", "oi"), ("section", "related-posts", "links", "oi"),
    ("div", "recommended", "links", "oi"), ("div", "tags", "links", "oi"), ("div", "share social", "links", "oi"),
    ("div", "social-links", "links", "oi"), ("div", "author-box", "text", "o"), ("div", "pagination pager", "links", "oi"),
    ("div", "cookie", "text", "o"), ("div", "cookie-banner consent", "text", "o"), ("div", "notice", "text", "oi"),
    ("div", "alert", "text", "oi"), ("div", "popup modal", "text", "o"), ("div", "gdpr privacy", "text", "o"),
    ("div", "banner", "text", "oi"), ("div", "subscribe", "text", "oi"), ("div", "newsletter", "form", "oi"),
    ("div", "ad", "text", "oi"), ("div", "ads", "text", "oi"), ("div", "advert", "text", "oi"),
    ("div", "advertisement", "text", "oi"), ("div", "sponsored", "text", "oi"), ("div", "sponsor", "text", "oi"),
    ("div", "promo", "text", "oi"), ("aside", "ad", "text", "oi"), ("div", "adsense", "text", "oi"),
    ("form", "", "form", "oi"), ("form", "search", "form", "o"), ("form", "login", "form", "o"),
    ("form", "contact", "form", "oi"), ("div", "search", "form", "o"),
    ("div", "comments", "comments", "oi"), ("section", "comments", "comments", "oi"), ("div", "comment", "text", "oi"),
    ("section", "comment-list", "comments", "oi"), ("ol", "commentlist", "comments", "oi"),
    ("div", "responses", "comments", "o"), ("div", "discussion", "comments", "o"), ("div", "reviews", "comments", "o")]
#: Names that mark a container inside an article as boilerplate.
_ASIDE = {f"name:{p}" for _, names, _, _ in _BOILERPLATE for p in names.replace("-", " ").split()}
_ASIDE |= {"in:nav", "in:aside", "in:footer", "in:form"}


def distant_label(ancestors: tuple[str, ...]) -> bool | None:
    """Whether a block is content by its landmarks; None on a page part that
    the page's own markup does not tell apart."""
    if "in:article" not in ancestors:
        return False
    return not _ASIDE.intersection(ancestors)


def redesign(content: list[str], other: list[str], rng: random.Random) -> list[tuple[list[str], bool]]:
    """(features, is content) of the blocks of the same texts in another design."""
    say = html.escape
    other = other or ["Menu", "Contact"]
    pool = [w for t in other for w in t.split()] or ["Home"]

    def words(a: int, b: int) -> str:
        return say(" ".join(rng.choice(pool) for _ in range(rng.randint(a, b))))

    def filling(kind: str) -> str:
        passage = f"<p>{say(rng.choice(content)) if content and rng.random() < 0.6 else words(4, 40)}</p>"
        if kind == "links":
            return "".join(f'<li><a href="#">{words(1, 3)}</a></li>' for _ in range(rng.randint(2, 6)))
        if kind == "title":
            return f'<a href="/">{words(1, 3)}</a><p>{words(2, 8)}</p>'
        if kind == "foot":
            return rng.choice(["&copy; ", "", ""]) + words(2, 12) + rng.choice(["", f'<a href="#">{words(1, 2)}</a>'])
        if kind == "form":
            return f"<label>{words(1, 4)}</label><input><button>{words(1, 2)}</button>" + rng.choice(["", f"<p>{words(3, 9)}</p>"])
        if kind == "comments":
            return f"<h3>{words(1, 3)}</h3>" + "".join(
                f"<div><b>{words(1, 2)}</b><p>{words(5, 50)}</p></div>" for _ in range(rng.randint(1, 3))) + passage
        return rng.choice([words(2, 20), passage, f"<h4>{words(1, 3)}</h4>{passage}"])

    def boilerplate(inside: bool) -> str:
        tag, names, kind, where = rng.choice([b for b in _BOILERPLATE if not inside or "i" in b[3]])
        attribute = rng.choice(["class", "class", "id"])
        return f'\x01<{tag}' + (f' {attribute}="{names}"' if names else "") + f">{filling(kind)}</{tag}>\x02"

    tag, names = rng.choice(_CONTENT)
    body = []
    for i, text in enumerate(content):
        shape = rng.choice(["p", "p", "p", "p", "li", "blockquote", "h2"]) if i else rng.choice(["h1", "p"])
        body.append(f"<{shape}>{say(text)}</{shape}>")
        if rng.random() < 0.06:
            body.append(boilerplate(True))
    page = "<body>" + "".join(boilerplate(False) for _ in range(rng.randint(0, 4)))
    page += rng.choice(["", '<div class="wrapper">', '<div id="container">', "<main>"])
    page += f"<{tag}" + (f' class="{names}"' if names else "") + ">" + "".join(body) + f"</{tag}>"
    page += "".join(boilerplate(False) for _ in range(rng.randint(0, 4)))
    found, depth = [], 0
    for block in blocks(page):
        # marks tell which side a block is on; they are no part of its features
        before = depth > 0
        depth += block.text.count("\x01") - block.text.count("\x02")
        if block.text.strip("\x01\x02 "):
            found.append((block.features, not (before or depth > 0 or "\x01" in block.text or "\x02" in block.text)))
    return found


class Crf:
    """Weights of features and label pairs; label 1 is content."""

    def __init__(self, weights: dict[str, float], start: np.ndarray, move: np.ndarray):
        self.weights, self.start, self.move = weights, start, move

    def labels(self, rows: list[list[str]]) -> list[bool]:
        """Viterbi path over the blocks of one page."""
        get = self.weights.get
        (m00, m01), (m10, m11) = self.move.tolist()
        s0, s1 = self.start.tolist()
        back = []
        for i, features in enumerate(rows):
            e = sum([get(f, 0.0) for f in features])
            if i:
                from0, from1 = s0 + m01 > s1 + m11, s0 + m00 >= s1 + m10
                back.append((from1, from0))
                s0, s1 = max(s0 + m00, s1 + m10), max(s0 + m01, s1 + m11) + e
            else:
                s1 += e
        path = [s1 > s0]
        for stay0, to1_from0 in reversed(back):
            path.append(not to1_from0 if path[-1] else not stay0)
        return path[::-1] if rows else []


def train(pages: list[list[tuple[list[str], bool]]], penalty: float = PENALTY, rounds: int = ROUNDS) -> Crf:
    """Conditional likelihood by Adam steps over all sequences at once."""
    pages = [p for p in pages if p]
    names = {f: i for i, f in enumerate(sorted({f for p in pages for fs, _ in p for f in fs}))}
    n, longest = len(pages), max((len(p) for p in pages), default=0)
    if not n:
        return Crf({"in:article": 1.0, "bias": -0.5}, np.zeros(2), np.zeros((2, 2)))
    rows, cols, at = [], [], 0
    gold, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    place = np.full((n, longest), -1)
    for i, page in enumerate(pages):
        for j, (features, label) in enumerate(page):
            rows += [at] * len(features)
            cols += [names[f] for f in features]
            gold[i, j], mask[i, j], place[i, j] = label, True, at
            at += 1
    rows, cols = np.array(rows), np.array(cols)
    theta = np.zeros(len(names) + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    ends = mask.sum(1) - 1
    for step in range(1, rounds + 1):
        w, start, move = theta[:-6], theta[-6:-4], theta[-4:].reshape(2, 2)
        emission = np.append(np.bincount(rows, w[cols], minlength=at), 0.0)
        e = np.stack([np.zeros((n, longest)), emission[place]], axis=2)
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = start + e[:, 0]
        for t in range(1, longest):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], nxt, alpha[:, t - 1])
        z = np.logaddexp.reduce(alpha[np.arange(n), ends], axis=1)
        for t in range(longest - 2, -1, -1):
            nxt = np.logaddexp.reduce(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], nxt, 0.0)
        p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
        block_gradient = np.zeros(at)
        block_gradient[place[mask]] = (p[:, :, 1] - gold)[mask]
        g = np.zeros_like(theta)
        g[:-6] = np.bincount(cols, block_gradient[rows], minlength=len(names))
        g[-6:-4] = p[:, 0].sum(0) - np.bincount(gold[:, 0], minlength=2)
        pair = np.zeros((2, 2))
        for t in range(1, longest):
            joint = np.exp(alpha[:, t - 1, :, None] + move + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None])
            pair += (joint * mask[:, t, None, None]).sum(0)
            pair -= np.histogram2d(gold[:, t - 1][mask[:, t]], gold[:, t][mask[:, t]], bins=[[0, 1, 2]] * 2)[0]
        g[-4:] = pair.ravel()
        g = g / n + penalty * theta / n
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        theta -= 0.2 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Crf({f: float(theta[i]) for f, i in names.items()}, theta[-6:-4], theta[-4:].reshape(2, 2))


def fit(pages: DataFrame, sample: int = SAMPLE, designs: int = DESIGNS) -> Crf:
    """Train on at most ``sample`` pages with an article, chosen by a hash of
    page_id and url, each as it is and in ``designs`` other designs. Without
    any such page an ``<article>`` is content and all else is not."""
    keyed = pages.select(F.xxhash64("page_id", "url").alias("_key"), "html").filter(
        F.col("html").ilike("%<article%"))
    rows = keyed.select("_key").distinct().orderBy("_key").limit(sample)
    # one page for each key, the smallest by hash: bounded by the sample however many pages share a key
    chosen = keyed.join(F.broadcast(rows), "_key", "left_semi").groupBy("_key").agg(
        F.min_by("html", F.xxhash64("html")).alias("html"))

    def sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, page in zip(pdf["_key"], pdf["html"]):
                found = [(b, bool(distant_label(b.ancestors))) for b in blocks(page)][:TRAIN_BLOCKS]
                rng = random.Random(int(key))
                content, other = [b.text for b, y in found if y], [b.text for b, y in found if not y]
                made = [[(b.features, y) for b, y in found]]
                made += [redesign(content, other, rng)[:TRAIN_BLOCKS] for _ in range(designs)]
                yield pd.DataFrame({"key": [int(key)] * len(made), "features": [
                    ["\x1f".join(f) for f, _ in m] for m in made], "gold": [[int(y) for _, y in m] for m in made]})

    made = materialise(chosen.mapInPandas(sequences, "key long, features array<string>, gold array<int>"), "html-sample")
    collected = made.orderBy("key", F.xxhash64("features")).collect()  # bounded by the three parameters
    return train([[(f.split("\x1f"), bool(y)) for f, y in zip(r["features"], r["gold"])] for r in collected])


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars, n_blocks, n_content.

    A null or empty page has the empty text. Blocks labelled content are joined
    by one space in page order; nothing is cut off. Rows come back as often as
    given; other columns are not read.
    """
    @F.pandas_udf("text string, n_chars long, n_blocks int, n_content int")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for page in rows:
                found = blocks(page, model.weights)  # features without a weight add nothing
                kept = [b.text for b, y in zip(found, model.labels([b.features for b in found])) if y]
                text = " ".join(kept)
                out.append((text, len(text), len(found), len(kept)))
            yield pd.DataFrame(out, columns=["text", "n_chars", "n_blocks", "n_content"])

    return pages.select("page_id", "url", udf("html").alias("_r")).select("page_id", "url", "_r.*")
