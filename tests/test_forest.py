"""The multi-output forest: every split against plain Python, bootstrap sums, compiled cells."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.operators import coldstart, forest
from reelrank.plans.catalog import Catalog


def explained(rows):
    """Sum over the targets of sum^2 / weight."""
    total = 0.0
    for j in range(len(rows[0][2]) if rows else 0):
        weight = sum(r[2][j] for r in rows)
        total += sum(r[3][j] for r in rows) ** 2 / weight if weight else 0.0
    return total


def plain_tree(rows, levels, depth, min_split, above):
    """Rows (cell, n, w, s) -> nested (split, left, right) or values."""
    weight = [sum(r[2][j] for r in rows) for j in range(len(above))]
    value = [sum(r[3][j] for r in rows) / weight[j] if weight[j] else above[j] for j in range(len(above))]
    best = None
    if sum(r[1] for r in rows) >= min_split and depth > 0:
        tries = [(0, b) for b in sorted({r[0][0] for r in rows})[:-1]]
        tries += [(k, lv) for k, size in enumerate(levels, 1) for lv in range(size)]
        for f, at in tries:
            right = [r for r in rows if (r[0][f] > at if f == 0 else r[0][f] == at)]
            left = [r for r in rows if not (r[0][f] > at if f == 0 else r[0][f] == at)]
            if left and right:
                gain = explained(left) + explained(right)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, (f, at), left, right
    if best is None or best[0] <= explained(rows) + 1e-9 * max(1.0, explained(rows)):
        return value
    return (best[1], *(plain_tree(part, levels, depth - 1, min_split, value) for part in best[2:]))


def nested(nodes, k=0):
    _, feature, at, left, right, _, value = nodes[k]
    return value if feature < 0 else ((feature, at), nested(nodes, left), nested(nodes, right))


def same(a, b):
    if isinstance(a, list) or isinstance(b, list):
        return isinstance(a, list) and isinstance(b, list) and np.allclose(a, b)
    return a[0] == b[0] and same(a[1], b[1]) and same(a[2], b[2])


@pytest.mark.parametrize("seed", range(12))
def test_tree_equals_plain_tree(seed):
    rng = random.Random(seed)
    targets, levels = rng.choice([1, 3]), [2, 3]
    rows = []
    for cell in {(rng.randrange(7), rng.randrange(3), rng.randrange(4)) for _ in range(40)}:
        n = rng.randint(1, 4)
        w = [float(rng.choice([0, n, n + 1])) for _ in range(targets)]
        rows.append((cell, n, w, [x * rng.uniform(0, 5) if x else 0.0 for x in w]))
    rows.sort()
    depth, min_split = rng.choice([2, 30]), rng.choice([2, 5])
    got = forest.grow(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]),
                      np.array([r[3] for r in rows]), levels, depth, min_split)
    assert same(nested(got), plain_tree(rows, levels, depth, min_split, [0.0] * targets))


def test_bootstrap_sums_do_not_depend_on_partitions(spark):
    rows = spark.range(500).select("id", F.expr("int(id % 7)").alias("b"), F.expr("int(id % 2)").alias("c"),
                                   F.expr("CASE WHEN id % 5 > 0 THEN id / 3D END").alias("t"))
    read = lambda df: sorted(tuple(map(str, r)) for r in forest.cell_sums(df, "id", ["b", "c"], ["t"], 20, 42).selectExpr(
        "tree", "b", "c", "n_rows", "w", "transform(s, x -> round(x, 6))").collect())
    assert read(rows.repartition(3)) == read(rows.repartition(11, "id"))
    weights = forest.cell_sums(rows.filter("t is not null"), "id", ["b", "c"], ["t"], 200, 42).selectExpr(
        "sum(w[0]) / 200 / 400 mean", "sum(n_rows) / 200 / 400 share").first()
    assert abs(weights.mean - 1) < 0.02 and abs(weights.share - 0.632) < 0.02  # Poisson(1), and 1 - 1/e of the rows


@pytest.fixture(scope="module")
def model(spark, sf_small):
    c = Catalog(spark, sf_small)
    return c, coldstart.fit_genre_model(c.profiles, num_trees=7)


def test_compiled_cells_equal_a_walk_down_every_tree(spark, model):
    c, m = model
    trees = {}
    for r in m.nodes.collect():
        trees.setdefault(r.tree, {})[r.node] = r
    assert len(trees) == 7
    asked = c.all_users.selectExpr("userId AS requestId", "age", "gender", "occupation").unionByName(
        spark.createDataFrame([(-1, None, "M", "astronaut"), (-2, 500, None, None)], "requestId long, age int, gender string, occupation string"))
    cells = {r.requestId: r for r in asked.withColumns(m.cell_columns()).collect()}
    got = coldstart.predict_genre_scores(m, asked).collect()
    assert len(got) == len(cells)
    for r in got[::7] + got[-2:]:
        want = np.zeros(18)
        for nodes in trees.values():
            k = nodes[0]
            while k.feature >= 0:
                x = cells[r.requestId][coldstart.CELL[k.feature]]
                k = nodes[k.right if (x > k.at if k.feature == 0 else x == k.at) else k.left]
            want += k.value
        assert np.allclose([r[p] for p in coldstart.prediction_columns()], want / 7)


def test_splits_respect_the_least_number_of_users(model):
    _, m = model
    assert m.nodes.filter(f"feature >= 0 AND n_rows < {coldstart.RF_MIN_SPLIT}").isEmpty()
    assert m.nodes.filter("feature >= 0").count() > 50


def test_one_target_forest_beats_the_mean_on_planted_demographics(spark):
    rng = random.Random(3)
    cols = ", ".join(f"{c} double" for c in coldstart.PROFILE_COLUMNS)
    truth = lambda age, g, o: (4 if g == "F" else 2) + (1 if age > 40 else 0) + (o == "writer")
    people = [(i, rng.randint(18, 70), rng.choice("FM"), rng.choice(["writer", "artist", "none"])) for i in range(800)]
    rows = [(*p, *([truth(*p[1:]) + rng.gauss(0, .3)] * 18)) for p in people]
    ddl = "userId long, age int, gender string, occupation string, " + cols
    m = coldstart.fit_genre_model(spark.createDataFrame(rows[:600], ddl), num_trees=20)
    asked = spark.createDataFrame([r[:4] for r in rows[600:]], "requestId long, age int, gender string, occupation string")
    got = {r.requestId: r.pred_drama for r in coldstart.predict_genre_scores(m, asked).collect()}
    error = [abs(got[p[0]] - truth(*p[1:])) for p in people[600:]]
    assert sum(error) / len(error) < 0.2


def test_many_ages_are_binned(spark):
    df = spark.range(1000).selectExpr("id AS age")
    cuts = forest.borders(df, "age", 16)
    assert len(cuts) <= 15 and cuts == sorted(cuts)
    counts = [r["count"] for r in df.groupBy(forest.bin_of(F.col("age"), cuts).alias("b")).count().collect()]
    assert len(counts) == len(cuts) + 1 and max(counts) < 100
    assert forest.borders(spark.range(4).selectExpr("id * 2 AS age"), "age", 16) == [1.0, 3.0, 5.0]
