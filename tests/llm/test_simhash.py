"""SimHash groups against a plain all-pairs version."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from reelrank.llm import simhash
from reelrank.llm.common import materialise
from reelrank.llm.components import connected_components


def brute_fingerprint(text, shingle=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, values, bits):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in range(len(ids)):
        for b in range(a):
            if bin(values[a] ^ values[b]).count("1") <= bits:
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "A b C d", "É é E e x", "a " * 9, "w\x0bx\x1cy z q r"])
def test_fingerprint_of_edge_texts(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def test_groups_equal_all_pairs(frame, sentence):
    rng = random.Random(5)
    rows = [(i, sentence(i, 60)) for i in range(40)]
    for i in range(40, 90):  # near copies: some words changed
        words = rows[rng.randrange(8)][1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "  ")]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(rows)).collect()}
    values = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], values, 4)
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{v:016x}" for (i, _), v in zip(rows, values)}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert want[102] == 100


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
@pytest.mark.parametrize("hot,block", [(64, 2048), (2, 3)])
def test_links_are_complete(spark, bits, hot, block):
    rng = random.Random(bits)
    values = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        values.add(seed)
        for _ in range(9):  # a dense group around the seed
            v = seed
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.links(frame, bits, hot, block)
    assert found.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > bits).isEmpty()
    got = {r["node"]: r["component"] for r in connected_components(found).collect()}
    want = brute_components(signed, [v % (1 << 64) for v in signed], bits)
    groups = lambda d: sorted(sorted(k for k in signed if d.get(k, k) == c) for c in {d.get(k, k) for k in signed})
    assert groups(got) == groups(want)


def test_probes_are_never_broadcast(spark, frame):
    """From a table of known size Spark takes the exploded probes for as small as the fingerprints."""
    fps = materialise(frame([(i * 0x9E3779B97F4A7C15 % (1 << 63),) for i in range(500)], "fp long"), "test-fps")
    plan = simhash.links(fps)._jdf.queryExecution().sparkPlan().toString()
    assert not re.search(r"BroadcastHashJoin .*Inner", plan), plan
    assert "SortMergeJoin" in plan


def test_keep_one_repeats_nulls_and_clashing_columns(spark, sentence):
    same = sentence(1, 50)
    rows = [(3, same, "a", 1), (2, same, "b", 2), (2, same, "b", 2), (None, same, "c", 3), (7, sentence(2, 50), "d", 4),
            (None, sentence(3, 50), "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[4], rows[5]], key=str)


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.keep_one(frame([])).count() == 0


def test_components_long_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(300, 300), (500, 400), (400, 500)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}


def test_blocks_of_a_hot_key_are_bounded_on_both_sides(spark, frame, monkeypatch):
    rng = random.Random(3)
    second, nwidth = simhash._segments(4)[1]
    # many fingerprints one place away seek the key that few hold
    values = {rng.getrandbits(64 - second - nwidth) << (second + nwidth) | (1 << second + k if k < nwidth else 0)
              for k in range(nwidth + 1) for _ in range(60)}
    large = spark.sparkContext.accumulator(0)
    forest = simhash._forest

    def checked(block_a, block_b, bits):
        if max(len(block_a), len(block_b)) > 90:
            large.add(1)
        return forest(block_a, block_b, bits)

    monkeypatch.setattr(simhash, "_forest", checked)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(frame([(v,) for v in signed], "fp long"), 4, 20, 40)
    parts = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert large.value == 0
    want = brute_components(list(range(len(signed))), [v % (1 << 64) for v in signed], 4)
    groups = {}
    for i, root in want.items():
        groups.setdefault(root, []).append(parts.get(signed[i], signed[i]))
    assert all(len(set(g)) == 1 for g in groups.values())
    assert len({g[0] for g in groups.values()}) == len(groups)
