from pyspark.sql import functions as F

from reelrank.operators import splits
from tests import fixtures as fx


def test_kfold_eleven_rows_five_folds(spark):
    r = fx.ratings(spark, [(u, 1, 3, 100 + u) for u in range(11)])
    out = splits.kfold_split(r, k=5).collect()
    assert len(out) == 11
    sizes = {}
    for row in out:
        sizes[row.fold] = sizes.get(row.fold, 0) + 1
    assert sorted(sizes) == [1, 2, 3, 4, 5] and sorted(sizes.values()) == [2, 2, 2, 2, 3]
    # contiguous in timestamp order
    by_ts = [row.fold for row in sorted(out, key=lambda x: x.timestamp)]
    assert by_ts == sorted(by_ts)


def test_kfold_many_partitions(spark, sf_small):
    from reelrank.plans.catalog import Catalog

    ratings = Catalog(spark, sf_small).ratings
    out = splits.kfold_split(ratings.repartition(7), k=5)
    n = ratings.count()
    counts = {r.fold: r["count"] for r in out.groupBy("fold").count().collect()}
    assert sum(counts.values()) == n and len(counts) == 5
    assert max(counts.values()) - min(counts.values()) <= 1


def test_leave_n_out_short_user_and_cap(spark):
    rows = [(1, m, 3, m) for m in range(1, 16)] + [(2, m, 3, m) for m in range(1, 4)]
    r = fx.ratings(spark, rows)
    out = splits.leave_n_out(r, start=1, stop=10).collect()
    test = [(x.userId, x.movieId) for x in out if x.part == "test"]
    assert len(out) == 18
    assert sorted(test) == [(1, m) for m in range(1, 11)] + [(2, 1), (2, 2), (2, 3)]
    capped = splits.leave_n_out(r, start=11, stop=20, max_test=3).filter("part = 'test'").collect()
    assert sorted((x.userId, x.movieId) for x in capped) == [(1, 11), (1, 12), (1, 13)]


def test_hash_split_is_stable_under_repartitioning(spark, sf_small):
    from reelrank.plans.catalog import Catalog

    ratings = Catalog(spark, sf_small).ratings
    a = splits.split_hash(ratings).filter("split = 'test'").select("userId", "movieId")
    b = splits.split_hash(ratings.repartition(5)).filter("split = 'test'").select("userId", "movieId")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = a.count() / ratings.count()
    assert 0.1 < share < 0.3


def test_random_split_is_disjoint_and_complete(spark, sf_small):
    from reelrank.plans.catalog import Catalog

    ratings = Catalog(spark, sf_small).ratings.cache()
    out = splits.split_random(ratings)
    assert out.count() == ratings.count()
    assert out.select("userId", "movieId").distinct().count() == ratings.count()
    assert out.filter(F.col("split") == "test").count() > 0


def test_two_leave_n_out_sets_are_disjoint_with_ten_per_user(spark, sf_small):
    from reelrank.plans.catalog import Catalog

    ratings = Catalog(spark, sf_small).ratings.cache()
    ua = splits.leave_n_out(ratings, 1, 10).filter("part = 'test'").select("userId", "movieId")
    ub = splits.leave_n_out(ratings, 11, 20).filter("part = 'test'").select("userId", "movieId")
    assert ua.intersect(ub).count() == 0
    per_user = ratings.groupBy("userId").count().withColumnRenamed("count", "n")
    got = ua.groupBy("userId").count().join(per_user, "userId")
    assert got.filter(F.col("count") != F.least(F.col("n"), F.lit(10))).count() == 0
    got_b = ub.groupBy("userId").count().join(per_user, "userId")
    assert got_b.filter(F.col("count") != F.least(F.col("n") - 10, F.lit(10))).count() == 0


def test_hash_split_of_long_and_negative_ids(spark):
    big = 9_223_372_036_854_775_807
    rows = [(u, m, 3, 1) for u in (big, 9_300_000_000_000, -big, 0) for m in (big, -5, 7)]
    got = {(r.userId, r.movieId): r.split for r in splits.split_hash(fx.ratings(spark, rows)).collect()}
    assert len(got) == 12 and set(got.values()) <= {"train", "test"}


def test_hash_split_tells_residue_twins_apart(spark):
    rows = [(u, m, 3, 1) for u in (1, 101, 201, 301) for m in range(400)]
    split = splits.split_hash(fx.ratings(spark, rows)).collect()
    tests = {u: {r.movieId for r in split if r.userId == u and r.split == "test"} for u in (1, 101, 201, 301)}
    assert len({frozenset(t) for t in tests.values()}) == 4


def test_evaluation_sets_cover_every_rating_once_each(spark):
    r = fx.ratings(spark, [(u, m, 3, 10 * u + m) for u in range(7) for m in range(25)])
    sets = splits.evaluation_sets(r, k=5, n=10)
    counts = {(x.set_name, x.part): x["count"] for x in sets.groupBy("set_name", "part").count().collect()}
    for name in ("u1", "u2", "u3", "u4", "u5", "ua", "ub"):
        assert counts[name, "base"] + counts[name, "test"] == 175
    assert sum(counts[f"u{i}", "test"] for i in range(1, 6)) == 175
    assert counts["ua", "test"] == counts["ub", "test"] == 70


def test_evaluation_sets_repeat_ratings_behind_the_last_shuffle(spark, tmp_path):
    from reelrank.sinks import tables

    r = fx.ratings(spark, [(u, m, 3, 10 * u + m) for u in range(7) for m in range(25)])
    sets = splits.evaluation_sets(r, k=5, n=10)
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.index("Generate") < plan.index("RepartitionByExpression")
    path = tables.publish_sorted(sets, str(tmp_path / "sets"), ["userId", "movieId"], ["set_name", "part"], ranged=True)
    read = spark.read.parquet(path).withColumn("file", F.input_file_name())
    spans = read.groupBy("set_name", "part", "file").agg(
        F.min(F.struct("userId", "movieId")).alias("a"), F.max(F.struct("userId", "movieId")).alias("b")).collect()
    for name, part in {(s.set_name, s.part) for s in spans}:
        mine = sorted((tuple(s.a), tuple(s.b)) for s in spans if (s.set_name, s.part) == (name, part))
        assert all(x[1] < y[0] for x, y in zip(mine, mine[1:]))
    rows = read.collect()
    want = {(x.userId, x.movieId): x.fold for x in splits.kfold_split(r, 5).collect()}
    assert all((x.part == "test") == (want[x.userId, x.movieId] == int(x.set_name[1:]))
               for x in rows if x.set_name[1:].isdigit())
    for name, start in (("ua", 1), ("ub", 11)):
        one = {(x.userId, x.movieId, x.part) for x in splits.leave_n_out(r, start, start + 9).collect()}
        assert {(x.userId, x.movieId, x.part) for x in rows if x.set_name == name} == one
