"""User genre profiles.

The profile is aggregated per ``userId`` *before* the join with the user
dimension: age, gender and occupation depend on the id, so grouping by the
id alone gives the same groups once users are unique by id, and the shuffle
carries 18 partial averages per user instead of every joined rating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.genres import GENRE_TO_PROFILE, GENRES, PROFILE_COLUMNS, genre_signature, mask_bit_sql

DEMOGRAPHICS = ["age", "gender", "occupation"]


def rating_facts(ratings: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """J2 + J3: ratings joined to item flags and user demographics (inner)."""
    flags = items.select("movieId", "title", *GENRES)
    demo = users.select("userId", *DEMOGRAPHICS)
    return (
        ratings.select("userId", "movieId", "rating", "timestamp")
        .join(flags, "movieId", "inner")
        .join(demo, "userId", "inner")
    )


def user_genre_sums(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Per user: 18 conditional averages in one aggregate (null if none).

    The item side of the join is just (movieId, 18-bit genre mask), 12 bytes
    a row, so Spark's size-checked broadcast can take it for catalogues of
    millions of items and the ratings are never shuffled for this join."""
    masks = items.select("movieId", genre_signature().alias("mask"))
    rated = ratings.select("userId", "movieId", "rating").join(masks, "movieId", "inner")
    aggs = [
        F.expr(f"avg(CASE WHEN {mask_bit_sql('mask', i)} = 1 THEN rating END)").alias(GENRE_TO_PROFILE[g])
        for i, g in enumerate(GENRES)
    ]
    return rated.groupBy("userId").agg(*aggs)


def user_genre_profile(ratings: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """userId, age, gender, occupation, avg_<genre> x 18.

    A user whose ratings only hit items with no genre keeps a row of nulls;
    ratings of unknown items or unknown users are dropped (inner joins).
    """
    sums = user_genre_sums(ratings, items)
    demo = users.select("userId", *DEMOGRAPHICS)
    return sums.join(demo, "userId", "inner").select("userId", *DEMOGRAPHICS, *PROFILE_COLUMNS)


def user_genre_profile_long(ratings: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """userId, genre, avg_rating, n_ratings for each genre a user rated.

    A rating meets one mask, not a row for each genre, and a user's ratings lie
    together before they are added up: a task's table of sums holds its own
    users only, not (user, genre) pairs of nearly all users in every task."""
    masks = items.select("movieId", genre_signature().alias("mask")).filter("mask <> 0")
    rated = (
        ratings.select("userId", "movieId", "rating")
        .join(masks, "movieId", "inner")
        .select("userId", "rating", "mask")
        .repartition("userId")
    )
    given = [f"CASE WHEN {mask_bit_sql('mask', i)} = 1 THEN rating END" for i in range(len(GENRES))]
    per = rated.groupBy("userId").agg(
        F.bit_or("mask").alias("mask"),
        *[F.expr(f"sum(CAST({g} AS DOUBLE))").alias(f"sum_{i}") for i, g in enumerate(given)],
        *[F.expr(f"count({g})").alias(f"n_{i}") for i, g in enumerate(given)])
    each = ", ".join(
        f"struct('{g}' AS genre, {mask_bit_sql('mask', i)} = 1 AS rated, try_divide(sum_{i}, n_{i}) AS avg_rating, "
        f"n_{i} AS n_ratings)" for i, g in enumerate(GENRES))
    known = per.join(users.select("userId"), "userId", "left_semi")
    return known.select("userId", F.expr(f"inline(array({each}))")).filter("rated").drop("rated")


def profile_targets(profiles: DataFrame) -> DataFrame:
    """The 18 averages with null replaced by 0 (model targets)."""
    return profiles.na.fill(0.0, subset=PROFILE_COLUMNS)
