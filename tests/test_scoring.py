"""The mask-pruned plan equals the exhaustive users x items ranking."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelrank.functions.genres import GENRES, PROFILE_COLUMNS
from reelrank.operators import scoring
from reelrank.plans.catalog import Catalog
from tests import fixtures as fx


def brute_force(profiles, items, k):
    """Every (user, item) pair scored; only for small test inputs."""
    w = [F.coalesce(F.when(F.col(c) != 0, F.col(c)), F.lit(0.0)) for c in PROFILE_COLUMNS]
    total = F.lit(1.0)
    for wi, g in zip(w, GENRES):
        total = total + wi * F.col(g)
    pairs = profiles.crossJoin(items.select("movieId", "title", *GENRES))
    scored = pairs.select("userId", "movieId", "title", F.round(total, 6).alias("score"))
    order = Window.partitionBy("userId").orderBy(F.col("score").desc(), F.col("movieId"))
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("userId", "rank", "movieId", "title", "score"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_two_step_equals_brute_force_on_test_tables(spark, sf_small):
    c = Catalog(spark, sf_small)
    for k in (1, 3, 10):
        assert rows(scoring.recommend_known(c.profiles, c.items, k)) == rows(brute_force(c.profiles, c.items, k))


def _profile(spark, weights: dict):
    cols = {c: weights.get(c) for c in PROFILE_COLUMNS}
    return spark.createDataFrame([{"userId": 1, **cols}],
                                 "userId long, " + ", ".join(f"{c} double" for c in PROFILE_COLUMNS))


def test_no_match_scores_base_and_ties_go_to_lower_id(spark):
    it = fx.items(spark, [(5, "e", set()), (3, "c", set()), (4, "d", set())])
    out = scoring.recommend_known(_profile(spark, {"avg_action": 4.0}), it, 10).collect()
    assert [(r.movieId, r.score, r.rank) for r in out] == [(3, 1.0, 1), (4, 1.0, 2), (5, 1.0, 3)]


def test_all_flags_sum_every_weight(spark):
    it = fx.items(spark, [(1, "all", set(GENRES)), (2, "none", set())])
    weights = {c: float(i + 1) for i, c in enumerate(PROFILE_COLUMNS)}
    out = scoring.recommend_known(_profile(spark, weights), it, 10).collect()
    assert out[0].movieId == 1 and out[0].score == 1.0 + sum(weights.values())


def test_fewer_items_than_k_gives_short_list(spark):
    it = fx.items(spark, [(1, "a", {"drama"}), (2, "b", {"war"})])
    out = scoring.recommend_known(_profile(spark, {"avg_war": 2.0}), it, 10).collect()
    assert [r.movieId for r in out] == [2, 1]


def test_zero_and_null_weights_do_not_count(spark):
    it = fx.items(spark, [(1, "a", {"drama"}), (2, "b", {"war"})])
    out = scoring.recommend_known(_profile(spark, {"avg_drama": 0.0}), it, 10).collect()
    assert [r.score for r in out] == [1.0, 1.0]


def test_new_user_ranking_ignores_non_positive_scores(spark, sf_small):
    from reelrank.operators.coldstart import prediction_columns, recommend_new

    c = Catalog(spark, sf_small)
    preds = prediction_columns()
    vals = [[(i * 7 % 11) / 3.0 - 1.0 for i in range(r, r + 18)] for r in range(4)]
    scores = spark.createDataFrame([(rid, *v) for rid, v in enumerate(vals)],
                                   "requestId long, " + ", ".join(f"{p} double" for p in preds))
    got = rows(recommend_new(scores, c.items, 10))
    pos = [F.when(F.col(p) > 0, F.col(p)).otherwise(F.lit(0.0)) for p in preds]
    total = F.lit(1.0)
    for wi, g in zip(pos, GENRES):
        total = total + wi * F.col(g)
    pairs = scores.crossJoin(c.items.select("movieId", "title", *GENRES))
    scored = pairs.select("requestId", "movieId", "title", F.round(total, 6).alias("score"))
    order = Window.partitionBy("requestId").orderBy(F.col("score").desc(), F.col("movieId"))
    want = (scored.withColumn("rank", F.row_number().over(order)).filter("rank <= 10")
            .select("requestId", "rank", "movieId", "title", "score"))
    assert got == rows(want)


def test_superset_limits_equal_a_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(40):
        bits, k = int(rng.integers(1, 7)), int(rng.integers(1, 5))
        masks = rng.permutation(1 << bits)[:rng.integers(1, (1 << bits) + 1)]
        top = np.iinfo(np.int32).max
        ranks = np.full((len(masks), k), top, np.int32)
        held = [sorted(rng.choice(100, rng.integers(1, k + 1), replace=False)) for _ in masks]
        for row, ids in zip(ranks, held):
            row[:len(ids)] = ids
        want = []
        for m in masks:
            above = sorted(x for n, ids in zip(masks, held) if n & m == m for x in ids) + [top] * k
            want.append(above[k - 1])
        assert scoring.superset_limits(masks, ranks, bits).tolist() == want


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_drops_no_item_of_any_list(spark, k):
    """Random items of many genres; weights of zero or more, negative and infinite ones."""
    rng = random.Random(k)
    it = fx.items(spark, [(i, f"t{i}", {g for g in GENRES if rng.random() < rng.choice([0.1, 0.5])})
                          for i in rng.sample(range(1000), 300)])
    kinds = [lambda: rng.choice([None, 0.0, 1.0, 2.5, rng.random() * 5]), lambda: rng.uniform(-3, 3),
             lambda: rng.choice([None, 1e-9, 1e300, 0.1]), lambda: 0.0]
    users = [{"userId": u, **{c: kinds[u % 4]() for c in PROFILE_COLUMNS}} for u in range(24)]
    profiles = spark.createDataFrame(users, "userId long, " + ", ".join(f"{c} double" for c in PROFILE_COLUMNS))
    assert rows(scoring.recommend_known(profiles, it, k)) == rows(brute_force(profiles, it, k))


def test_infinite_weights_use_all_masks(spark):
    it = fx.items(spark, [(1, "a", {"war"}), (2, "b", {"drama"}), (3, "c", {"war", "drama"})])
    out = scoring.recommend_known(_profile(spark, {"avg_war": float("inf")}), it, 1).collect()
    assert [r.movieId for r in out] == [2]  # infinity times no genre is no number, which ranks first


def test_skyband_leaves_out_what_many_larger_masks_precede(spark):
    """Items of up to four genres behind twelve that have all four."""
    few = GENRES[:4]
    rng = random.Random(8)
    it = fx.items(spark, [(i, "all", set(few)) for i in range(12)]
                  + [(i, "some", {g for g in few if rng.random() < 0.5}) for i in range(12, 200)])
    kept = scoring.mask_table(scoring.mask_items(it, 10))
    marked = {r["mask"]: r["keep"] for r in scoring.skyband(kept, 10).collect()}
    assert len(marked) > 10 and marked.pop(15) == 10 and set(marked.values()) == {0}


def test_equal_predicted_scores_are_ranked_once(spark, sf_small, monkeypatch):
    from reelrank.operators import coldstart
    from reelrank.plans.catalog import Catalog

    items, preds = Catalog(spark, sf_small).items, coldstart.prediction_columns()
    cells = [[0.1 * ((i * j) % 7) for i in range(len(preds))] for j in (1, 2, 3)]
    scores = spark.createDataFrame([(r, *cells[r % 3]) for r in [*range(40), 5]], ["requestId", *preds])
    ranked = []

    def counted(weights, *args):
        ranked.append(weights.count())
        return top_k(weights, *args)

    top_k = coldstart.top_k_by_genre_weights
    monkeypatch.setattr(coldstart, "top_k_by_genre_weights", counted)
    once = sorted(tuple(r) for r in coldstart.recommend_new(scores, items, 10).collect())
    assert ranked == [3]
    monkeypatch.setattr(coldstart, "BROADCAST_LISTS", 0)
    each = sorted(tuple(r) for r in coldstart.recommend_new(scores, items, 10).collect())
    assert ranked == [3, 41]
    assert once == each and len(once) == 400
