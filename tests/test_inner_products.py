"""Exact pruned inner products against brute force."""

import numpy as np
import pytest

from reelrank.operators import inner_products
from reelrank.operators.inner_products import chunk_borders, top_products


def frame_of(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id int, features array<float>")


def brute(users, items, k, seen=()):
    out = {}
    for u, v in users:
        scores = [(np.float32(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), i)
                  for i, w in items if (u, i) not in seen]
        out[u] = [i for _, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def got_of(frame):
    return {r.userId: list(r.ids) for r in frame.collect()}


@pytest.mark.parametrize("shape", ["positive", "signed", "ties"])
def test_equals_brute_force_over_several_chunks(spark, shape):
    rng = np.random.default_rng(7)
    draw = {"positive": lambda n: rng.random((n, 6)) ** 4, "signed": lambda n: rng.normal(size=(n, 6)),
            "ties": lambda n: rng.integers(-1, 3, (n, 6)).astype(float)}[shape]
    users, items = list(enumerate(draw(60))), list(enumerate(draw(3000), start=100))
    users.append((60, np.zeros(6)))  # every product is zero
    seen = {(u, int(i)) for u in range(40) for i in rng.integers(100, 3100, 30 * u)}
    seen |= {(5, i) for i in range(100, 3096)}  # four items are left
    seen |= {(6, i) for i in range(100, 3100)}  # none is left
    pairs = spark.createDataFrame([*seen, *list(seen)[:50], (999, 100), (1, -7)], "userId long, movieId long")
    uf, itf = frame_of(spark, users), frame_of(spark, items)
    assert got_of(top_products(uf, itf, 10, pairs, first=300, chunk_bytes=1000 * 64)) == brute(users, items, 10, seen)
    assert got_of(top_products(uf, itf, 10)) == brute(users, items, 10)


def test_bounds_end_most_scans(spark):
    rng = np.random.default_rng(3)
    items = [(i, rng.random(4) * (50.0 if i < 500 else 1.0)) for i in range(20_000)]
    users = list(enumerate(rng.random((50, 4)) + 0.1))
    rows = top_products(frame_of(spark, users), frame_of(spark, items), 10, first=1024).collect()
    assert {r.userId: list(r.ids) for r in rows} == brute(users, items, 10)
    assert max(r.n_scored for r in rows) <= 1024  # of 20,000


def test_empty_tables_and_borders(spark):
    none, some = frame_of(spark, []), frame_of(spark, [(1, [1.0, 2.0])])
    assert top_products(none, some, 3).count() == 0
    assert got_of(top_products(some, none, 3)) == {1: []}
    assert got_of(top_products(some, some, 3, spark.createDataFrame([], "userId long, movieId long"))) == {1: [1]}
    assert chunk_borders(0, 10) == [0] and chunk_borders(5, 10, first=2) == [0, 2, 5]
    borders = chunk_borders(10**8, 10)
    assert max(b - a for a, b in zip(borders, borders[1:])) * (8 * 10 + 16) <= inner_products.CHUNK_BYTES
