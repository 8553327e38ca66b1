"""The curve's properties, and the shards' law on odd tables."""

import zlib
from collections import Counter

import numpy as np
import pytest

from reelrank.llm.hilbert import hilbert_index, shard_documents

DDL = "doc_id long, text string, source string, lang string"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (3, 1)])
def test_curve_visits_every_cell_once_by_single_steps(dims, bits):
    grid = np.array(np.meshgrid(*[range(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
    index = hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(index)))
    steps = np.abs(np.diff(grid[:, np.argsort(index)], axis=1)).sum(0)
    assert (steps == 1).all()


def check(rows, got, shards=8):
    assert len(got) == len(rows)
    n = Counter(r["shard"] for r in got)
    sizes = [n.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and not set(n) - set(range(shards))
    for s in n:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n[s]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)


def test_law_with_nulls_ties_repeats_and_copies(spark, sentence):
    rows = [(i, sentence(i, 5 + i % 40), f"src{i % 7}", "en" if i % 3 else "fr") for i in range(100)]
    rows += [(i, "the same copy", f"src{i % 5}", None) for i in range(200, 260)]
    rows += [(None, None, None, None), (None, "", None, ""), (5, "é" * 50_000, "x", "y"), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, DDL)
    got = shard_documents(frame).collect()
    check(rows, got)
    order = sorted((r["shard"], r["slot"], r["text_crc32"]) for r in got)
    copies = [i for i, r in enumerate(order) if r[2] == zlib.crc32(b"the same copy")]
    assert copies == list(range(copies[0], copies[0] + 60))  # equal texts stand together


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9])
def test_small_tables(spark, n):
    rows = [(i, f"t{i}", "s", "l") for i in range(n)]
    check(rows, shard_documents(spark.createDataFrame(rows, DDL)).collect())


def test_missing_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a", 3, 4), (2, "b", 5, 6)], "doc_id int, text string, shard int, hilbert int")
    check([(1, "a"), (2, "b")], shard_documents(frame).collect())


def plain_order(rows, hashes, bits=5):
    """Places of (doc_id, text): every cell computed from whole columns."""
    size = {t: len(t.encode()) + 1 for _, t, *_ in rows}
    least = {t: [min(r[k] or "" for r in rows if r[1] == t) for k in (2, 3)] for t in size}

    def name_cells(k):
        names = [v[k] for v in least.values()]
        return {x: (sum(y < x for y in names) + names.count(x) // 2 << bits) // len(names) for x in names}

    source, lang, ordered = name_cells(0), name_cells(1), sorted(size.values())
    cuts = [ordered[max(0, -(-len(ordered) * i // (1 << bits)) - 1)] for i in range(1, 1 << bits)]
    texts = list(size)
    axes = np.array([[source[least[t][0]] for t in texts], [lang[least[t][1]] for t in texts],
                     [sum(c < size[t] for c in cuts) for t in texts]])
    index = dict(zip(texts, hilbert_index(axes, bits)))
    return sorted((index[t], hashes[t], zlib.crc32(t.encode()), size[t], d is not None, d or 0) for d, t, *_ in rows)


def test_order_against_plain_version(spark, sentence):
    rows = [(i, sentence(i % 90, 3 + 7 * (i % 31)), f"https://example.org/{'abcdefgh'[i * i % 8]}{i % 3}", "fr" if i % 4 else "en")
            for i in range(120)] + [(None, "x", "src", "en"), (None, "x", "src", "en"), (3, "x", None, None)]
    frame = spark.createDataFrame(rows, DDL)
    hashes = {r[0]: r[1] for r in frame.selectExpr("text", "xxhash64(text)").collect()}
    got = shard_documents(frame).collect()
    check(rows, got)
    want = [(*k[:1], k[2], k[5] if k[4] else None) for k in plain_order(rows, hashes)]
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    assert [(r["hilbert"], r["text_crc32"], r["doc_id"]) for r in got] == want


def test_sources_with_one_beginning_are_told_apart(spark, sentence):
    rows = [(i, sentence(i, 10), f"dataset_{i % 8:03d}", "en") for i in range(160)]
    got = {r["doc_id"]: r["shard"] for r in shard_documents(spark.createDataFrame(rows, DDL)).collect()}
    spread = [len({got[i] for i in range(160) if i % 8 == s}) for s in range(8)]
    assert sum(spread) / 8 <= 4 and len(set(got.values())) == 8


def test_a_hot_row_is_put_out_in_chunks(spark, monkeypatch):
    from reelrank.llm import hilbert
    monkeypatch.setattr(hilbert, "COPIES", 7)
    rows = [(None, None, "s", "l")] * 50 + [(i, "a", "s", "l") for i in range(9)]
    check(rows, shard_documents(spark.createDataFrame(rows, DDL)).collect())
