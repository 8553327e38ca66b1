import re

from pyspark.sql import functions as F

from reelrank.operators import cleaning, items as item_ops, profiles
from reelrank.sources.files import ITEMS_SCHEMA
from tests import fixtures as fx


def test_latest_rating_wins(spark):
    r = fx.ratings(spark, [(1, 10, 2, 100), (1, 10, 5, 200)])
    out = cleaning.clean_ratings(r).collect()
    assert [(x.rating, x.timestamp) for x in out] == [(5, 200)]


def test_null_rating_does_not_hide_valid_one(spark):
    r = fx.ratings(spark, [(1, 10, 4, 100), (1, 10, None, 200)])
    out = cleaning.clean_ratings(r).collect()
    assert [(x.rating, x.timestamp) for x in out] == [(4, 100)]


def test_equal_timestamps_break_ties_deterministically(spark):
    r = fx.ratings(spark, [(1, 10, 2, 100), (1, 10, 3, 100)])
    a = cleaning.clean_ratings(r).collect()
    b = cleaning.clean_ratings(r.repartition(4)).collect()
    assert a == b and len(a) == 1


def test_duplicate_item_does_not_fan_out(spark):
    it = fx.items(spark, [(1, "a", {"action"}), (1, "a", {"action"}), (2, "b", {"drama"})])
    r = fx.ratings(spark, [(7, 1, 4, 1)])
    table = item_ops.item_table(cleaning.dedup_items(it), r)
    assert table.count() == 2
    assert table.filter("movieId = 1").first().n_ratings == 1


def test_unrated_item_keeps_null_average(spark):
    it = fx.items(spark, [(1, "a", {"action"}), (2, "b", {"drama"})])
    r = fx.ratings(spark, [(7, 1, 4, 1)])
    row = item_ops.item_stats(it, r).filter("movieId = 2").first()
    assert row.avg_rating is None and row.n_ratings == 0


def test_inner_joins_drop_unknown_item_and_user(spark):
    it = fx.items(spark, [(1, "a", {"action"})])
    us = fx.users(spark, [(7, 30, "M", "writer", "A1B2C")])
    r = fx.ratings(spark, [(7, 1, 4, 1), (7, 99, 5, 1), (8, 1, 3, 1)])
    facts = profiles.rating_facts(r, it, us).collect()
    assert [(f.userId, f.movieId) for f in facts] == [(7, 1)]


def test_user_with_only_unknown_items_keeps_null_profile(spark):
    it = fx.items(spark, [(1, "nothing", set())])
    us = fx.users(spark, [(7, 30, "M", "writer", "A1B2C")])
    r = fx.ratings(spark, [(7, 1, 4, 1)])
    rows = profiles.user_genre_profile(r, it, us).collect()
    assert len(rows) == 1
    assert all(rows[0][c] is None for c in profiles.PROFILE_COLUMNS)


def test_film_noir_and_sci_fi_count(spark):
    it = fx.items(spark, [(1, "x", {"film_noir"}), (2, "y", {"sci_fi"})])
    us = fx.users(spark, [(7, 30, "M", "writer", "z")])
    r = fx.ratings(spark, [(7, 1, 4, 1), (7, 2, 2, 1)])
    row = profiles.user_genre_profile(r, it, us).first()
    assert row.avg_filmnoir == 4.0 and row.avg_scifi == 2.0


def test_flag_text_that_is_not_a_number(spark):
    row = [1, "Café | \"Noir\" (1950)", None, None, None, "0", "x", "1"] + ["0"] * 16
    df = spark.createDataFrame([row], ITEMS_SCHEMA)
    out = cleaning.cast_flags(df).first()
    assert out.action is None and out.adventure == 1 and out.invalid_flags == 1
    assert out.title == "Café | \"Noir\" (1950)"


def test_long_profile_matches_wide(spark, sf_small):
    from reelrank.plans.catalog import Catalog

    c = Catalog(spark, sf_small)
    wide = c.profiles.unpivot(["userId"], profiles.PROFILE_COLUMNS, "col", "avg").filter("avg IS NOT NULL")
    long = profiles.user_genre_profile_long(c.ratings, c.items, c.users)
    assert wide.count() == long.count()
    s1 = wide.agg(F.round(F.sum("avg"), 6)).first()[0]
    s2 = long.agg(F.round(F.sum("avg_rating"), 6)).first()[0]
    assert s1 == s2


def test_damaged_duplicate_never_wins(spark):
    sound = [1, "A title", None, None, None, "0", "1"] + ["0"] * 17
    damaged = [1, None, None, None, None, "0", "x"] + ["0"] * 17
    df = spark.createDataFrame([damaged, sound, damaged], ITEMS_SCHEMA)
    row = cleaning.clean_items(df).first()
    assert (row.title, row.action, row.invalid_flags) == ("A title", 1, 0)
    raw = cleaning.dedup_items(df).collect()
    assert len(raw) == 1 and raw[0].title == "A title"


def test_user_with_fewest_nulls_wins(spark):
    us = fx.users(spark, [(7, None, "F", None, "z"), (7, 30, "M", "writer", "a"), (7, 30, None, "writer", "a")])
    assert tuple(cleaning.dedup_users(us).first()) == (7, 30, "M", "writer", "a")


def test_long_profile_adds_up_by_user_only(spark):
    it = fx.items(spark, [(1, "x", {"drama", "war"}), (2, "y", {"war"}), (3, "z", set())])
    us = fx.users(spark, [(7, 30, "M", "writer", "z"), (8, 30, "M", "writer", "z"), (9, 30, "F", "writer", "z")])
    r = fx.ratings(spark, [(7, 1, 4, 1), (7, 2, 1, 1), (7, 3, 5, 1), (8, 2, None, 1), (9, 3, 2, 1), (10, 1, 5, 1), (7, 99, 5, 1)])
    long = profiles.user_genre_profile_long(r, it, us)
    got = sorted(tuple(x) for x in long.collect())
    assert got == [(7, "drama", 4.0, 1), (7, "war", 2.5, 2), (8, "war", None, 0)]
    # no table of (user, genre) pairs in a task
    assert not re.search(r"Aggregate \[userId#\d+L?, genre", long._jdf.queryExecution().optimizedPlan().toString())
