"""Periodic runs against every pair (start, period) of small sequences."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import periodic_runs as pr
from reelrank.llm.queries import QUERIES
from reelrank.llm.common import table


def plain_runs(words, least=12):
    """Every stretch with its smallest period, tried one by one."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= max(least - q, q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n_, q) for (s, n_), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, None if best[1] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def runs_of(words, least=12):
    return [tuple(r) for r in pr.find_runs(np.array(words, np.int64), least).T.tolist()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_small_alphabets(words):
    assert runs_of(words) == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=6),
       st.integers(2, 20))
def test_repeated_parts(parts, least):
    words = [w for part, times in parts for w in part * times]
    assert runs_of(words, least) == sorted(plain_runs(words, least), key=lambda r: (r[0], r[2]))


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    part = [rng.randrange(50) for _ in range(157)]
    inner = part + [7] * 30 + [1, 2] * 20
    words = [rng.randrange(900) for _ in range(400)] + inner * 5 + part[:80] + [rng.randrange(9) for _ in range(300)]
    assert runs_of(words) == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("make", [
    lambda n: [0] * n, lambda n: [0, 1] * (n // 2), lambda n: ([0] * 700 + [1]) * (n // 701),
    lambda n: [bin(i).count("1") & 1 for i in range(n)], lambda n: [0] * (n // 2) + [1] + [0] * (n // 2)])
def test_hostile_documents_take_near_linear_time(make):
    started = time.process_time()
    words = np.array(make(200_000), np.int64)
    runs = pr.find_runs(words)
    assert time.process_time() - started < 20
    for start, length, period in runs.T.tolist()[:200]:
        stretch = words[start:start + length]
        assert (stretch[period:] == stretch[:-period]).all()


def test_word_ids_over_several_chunks(monkeypatch):
    monkeypatch.setattr(pr, "CHUNK_BYTES", 5)
    data = b"\t one two\x0b three\x1cfour  one \x0c two\n"
    ids, words = pr.word_ids(data)
    assert [words[i] for i in ids] == re.findall(rb"[^\x20\x09-\x0D]+", data)


def test_rows_of_every_kind(spark, frame, sentence):
    loop = sentence(1, 40)
    texts = [None, "", " \n\t ", "a", "a " * 50, f"{loop} {loop} {loop[:90]}", f"x {loop}\n{loop}", "ab ab " * 9 + "ä é " * 9,
             sentence(2, 300), " ".join([sentence(3, 7)] * 400)]
    rows = [(i, t) for i in range(30) for t in texts[i % 3::3]] + [(None, "b " * 20), (None, "b " * 20), (5, texts[4]), (5, texts[4])]
    docs = frame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, runs string, h int")
    got = pr.digest(pr.detect(pr.with_planted_period(docs))).drop("n_words").collect()
    order = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted((plain_row(*r) for r in rows), key=order)


def test_query_against_plain_version(spark, sf_small):
    docs = table(spark, sf_small, "documents").select("doc_id", "text").collect()
    short = {r["doc_id"]: plain_row(*r) for r in docs if len(r["text"] or "") < 12_000}
    got = {r["doc_id"]: tuple(r)[:8] for r in QUERIES["op11_periodic_runs"](spark, sf_small).collect()}
    assert len(got) == len(docs) and len(short) > 0.8 * len(docs)
    assert {k: got[k] for k in short} == short


def test_empty_table(frame):
    assert pr.digest(pr.detect(pr.with_planted_period(frame([])))).count() == 0
