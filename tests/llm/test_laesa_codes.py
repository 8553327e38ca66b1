"""Product codes against plain integer k-means."""

import hashlib
import math
import random

import numpy as np
import pytest

from reelrank.llm import laesa_codes as lc

DDL = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """vec_id, code, error, label_error and digest, every distance computed."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    longest = max(len(v) for _, v, _ in kept)
    width = max(1, -(-longest // parts))
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            found = [min((sum((a - b) ** 2 for a, b in zip(row[p], e)), k) for k, e in enumerate(books[p]))
                     for p in range(parts)]
            out.append(found)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [row[p] for row, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    sums = {}
    for (_, _, label), f in zip(kept, found):
        sums[label] = sums.get(label, 0) + sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[label], digest)
            for (i, _, label), f in zip(kept, found)]


def check(frame, rows, **kw):
    got = lc.encode(frame(rows, DDL), **kw).drop("measured_milli").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows, **kw), key=str)


def vectors(seed, n, dims=8, groups=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, .4) for _ in range(dims)] for _ in range(groups)]
    return [(i, [rng.gauss(x, .1) for x in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("width", [1, 3, 16])
def test_nearest_is_the_exact_nearest(width, ties):
    rng = np.random.default_rng(width)
    spread = 4 if ties else 600
    entries = rng.integers(-spread, spread, (256, width))
    parts = np.concatenate([rng.integers(-spread, spread, (400, width)), entries[:50]])
    pivots = lc.choose_pivots(entries[None])[0]
    code, best, measured = lc.nearest(parts, lc._distances(parts, pivots).astype(np.float32), entries,
                                      lc._distances(entries, pivots))
    full = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (best == full.min(axis=1)).all() and (code == full.argmin(axis=1)).all()
    assert measured <= full.size


def test_pruning_saves_most_distances_in_clustered_parts():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (256, 6))
    parts = centres[rng.integers(0, 256, 2000)] + rng.integers(-40, 40, (2000, 6))
    pivots = lc.choose_pivots(centres[None])[0]
    *_, measured = lc.nearest(parts, lc._distances(parts, pivots).astype(np.float32), centres,
                              lc._distances(centres, pivots))
    assert measured < 0.1 * 2000 * 256


def test_large_components_stay_exact():
    top = lc._magnitude(8)
    entries = np.array([[top, 0], [top - 1, 0], [-top, 1]])
    parts = np.array([[top, 1], [top - 1, 0], [-top, -top]])
    pivots = lc.choose_pivots(entries[None])[0]
    code, best, _ = lc.nearest(parts, lc._distances(parts, pivots).astype(np.float32), entries, lc._distances(entries, pivots))
    assert code.tolist() == [0, 1, 2] and best.tolist() == [1, 0, (top + 1) ** 2]


def test_more_vectors_than_entries(frame):
    check(frame, vectors(1, 120), entries=16)


def test_fewer_vectors_than_entries(frame):
    check(frame, vectors(2, 30))


def test_rows_of_every_kind(frame):
    rng = random.Random(4)
    rows = vectors(3, 40, dims=6)
    rows += [(100, None, 1), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (102, [math.nan] * 6, 2), (103, [math.inf] + [0.0] * 5, 2),
             (None, [0.1] * 6, 3), (104, [], 3), (105, [0.5], None), (106, [0.0] * 6, None), (106, [-0.25] * 6, None)]
    rows += [rows[3]] * 5 + [rows[7]] * 5
    rng.shuffle(rows)
    check(frame, rows, entries=8)


def test_equal_vectors_only(frame):
    check(frame, [(i % 3, [0.25, -0.75, 0.1, 0.0], 1) for i in range(20)], entries=4)


def test_empty_and_unusable_tables(frame):
    assert lc.encode(frame([], DDL)).count() == 0
    assert lc.encode(frame([(1, None, 1)], DDL)).collect() == []


def test_clashing_and_missing_columns(frame):
    rows = [(i, v, "x", 5, [1]) for i, v, _ in vectors(5, 20)]
    got = lc.encode(frame(rows, "vec_id long, embedding array<float>, code string, error int, x array<int>"), entries=4)
    want = plain([(r[0], r[1], None) for r in rows], entries=4)
    assert sorted(map(tuple, got.drop("measured_milli").collect())) == sorted(want)
