"""Item statistics and the published item table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.genres import GENRES, UNKNOWN


def item_avg_rating(ratings: DataFrame) -> DataFrame:
    """A1: movieId, avg_rating, n_ratings (partial + final hash aggregate)."""
    return ratings.groupBy("movieId").agg(
        F.avg("rating").alias("avg_rating"),
        F.count("rating").alias("n_ratings"),
    )


def item_stats(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every item with its average; unrated items keep a null average and
    a count of 0. The statistics are aggregated before the join, so the join
    sees one row per item on both sides."""
    stats = item_avg_rating(ratings)
    joined = items.select("movieId", "title").join(stats, "movieId", "left")
    return joined.select(
        "movieId", "title", "avg_rating",
        F.coalesce(F.col("n_ratings"), F.lit(0)).alias("n_ratings"),
    )


def item_genres_long(items: DataFrame) -> DataFrame:
    """One row per (movieId, genre) with the flag set, canonical names."""
    long = items.select("movieId", *GENRES).unpivot(["movieId"], GENRES, "genre", "flag")
    return long.filter(F.col("flag") == 1).select("movieId", "genre")


def item_table(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """R5 output: movieId, title, avg_rating, n_ratings, unknown + 18 flags.

    ``items`` must be cleaned (:func:`reelrank.operators.cleaning.clean_items`)
    and ``ratings`` cleaned (:func:`reelrank.operators.cleaning.clean_ratings`).
    """
    stats = item_avg_rating(ratings)
    joined = items.join(stats, "movieId", "left")
    return joined.select(
        "movieId", "title", "avg_rating",
        F.coalesce(F.col("n_ratings"), F.lit(0)).alias("n_ratings"),
        UNKNOWN, *GENRES,
    )
