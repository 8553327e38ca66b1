"""Graphs and links against brute force."""

import numpy as np
import pytest

from reelrank.llm import hnsw

DDL = "vec_id long, embedding array<float>, label int"


def cluster(seed, groups, size, dims=16, noise=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return np.concatenate([c + noise * rng.normal(size=(size, dims)) for c in centres])


def brute(rows, threshold=0.98):
    """vec_id -> (links, component) for distinct ids."""
    good = [(i, np.array(v, float), y) for i, v, y in rows
            if y is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i, _, _ in rows}
    for a, u, y in good:
        for b, w, z in good:
            if a != b and y == z and len(u) == len(w) and u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= threshold:
                near[a].add(b)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(near[i]), min(seen))
    return out


@pytest.mark.parametrize("groups,size", [(400, 2), (5, 300), (1, 900), (900, 1)])
def test_recall_in_one_shard(groups, size):
    unit = hnsw._unit(cluster(groups, groups, size))
    graph = hnsw.Graph(unit)
    truth = unit @ unit.T >= 0.98
    found, beam, audited = hnsw.audited_links(graph, unit, unit, 0.98)
    got = np.zeros_like(truth)
    for i, f in enumerate(found):
        got[i, f] = True
    assert not (got & ~truth).any()
    assert (got & truth).sum() / truth.sum() >= 0.99


def test_tiny_graphs():
    for n in (1, 2, 3, 40):
        unit = hnsw._unit(np.random.default_rng(n).normal(size=(n, 4)))
        found, _, _ = hnsw.audited_links(hnsw.Graph(unit), unit, unit, 0.98)
        assert [i in f for i, f in enumerate(found)] == [True] * n


@pytest.mark.parametrize("shard_rows", [4096, 40])
def test_query_equals_brute_force(spark, shard_rows):
    vectors = [v.tolist() for v in cluster(3, 30, 6, noise=0.03)]
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0], 0) for i in range(50)]  # copies
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [None] + [1.0] * 15, 1),
             (2004, [float("nan")] * 16, 1), (2005, [float("inf")] + [1.0] * 15, 1), (2006, vectors[0], None),
             (2007, vectors[0][:8], 0), (2008, [2 * x for x in vectors[0]], 0)]
    got = hnsw.near_duplicates(spark.createDataFrame(rows, DDL), shard_rows=shard_rows).collect()
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    want = brute(single)
    assert len(got) == len(rows)
    wrong = [r["vec_id"] for r in got if (r["n_links"], r["component_id"]) != want[r["vec_id"]]]
    assert not wrong
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_repeated_rows_null_ids_clashing_columns_and_empty_tables(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v, 0, "a"), (5, v, 0, "a"), (None, v, 0, "b"), (None, None, None, "c"), (9, v, 0, "d")]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, part string")
    got = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in hnsw.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (-1, 3, 5), (-1, 0, None), (9, 3, 5)], key=str)
    assert hnsw.near_duplicates(docs.limit(0)).count() == 0


def test_given_embeddings(spark, sf_small):
    vectors = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hnsw.near_duplicates(vectors).collect()}
    assert got == brute(rows)
