"""Window removal against a plain set of seen windows."""

import random
import re

import pytest

from reelrank.llm import substring_dedup


def brute(rows, window):
    out, seen = [], set()
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            else:
                seen.add(key)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(words), sum(gone), runs, " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,batch_bytes", [(20, 4 << 20), (20, 900), (2, 300), (5, 1 << 30)])
def test_equals_brute_force(frame, sentence, window, batch_bytes):
    rng = random.Random(window)
    passages = [sentence(i, rng.randint(5, 70)) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [sentence(100 + i, rng.randint(0, 30))] + rng.sample(passages, rng.randrange(4))
        rng.shuffle(parts)
        rows.append((rng.randrange(50) - 5, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    rows += [(200, "a " * 100), (201, "a b " * 60), (202, None), (203, ""), (204, " \n "), (None, passages[0]),
             (None, passages[0]), (1 << 40, passages[1]), (-(1 << 40), passages[1]), rows[0], (300, "é ü x " * 30)]
    got = substring_dedup.dedup_substrings(frame(rows), window, batch_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, window)


def test_empty_table_and_extra_columns(spark, frame):
    assert substring_dedup.dedup_substrings(frame([])).count() == 0
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id int, text string, batch int, id string")
    assert [tuple(r) for r in substring_dedup.dedup_substrings(docs).collect()] == [(1, 2, 0, 0, "a b")]


def test_window_is_checked(frame):
    with pytest.raises(ValueError):
        substring_dedup.dedup_substrings(frame([]), 1)


def test_rows_of_one_id_lie_in_several_batches(spark, frame, sentence, monkeypatch):
    rows = [(None, sentence(i % 40, 60)) for i in range(80)] + [(7, sentence(100, 60))] * 40
    size, seen = 4000, spark.sparkContext.accumulator(0)
    load = substring_dedup._load

    def largest(pdf):
        if sum(len(t) for t in pdf["text"]) > 4 * size:
            seen.add(1)
        return load(pdf)

    monkeypatch.setattr(substring_dedup, "_load", largest)
    got = substring_dedup.dedup_substrings(frame(rows), 20, size).collect()
    assert seen.value == 0
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in got) == (
        [(False, 0)] + [(False, 60)] * 39 + [(True, 0)] * 40 + [(True, 60)] * 40)
