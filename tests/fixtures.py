"""Small hand-written inputs for edge cases (invented rows, not source data)."""

from pyspark.sql import types as T

from reelrank.functions.genres import ALL_FLAGS, GENRES

RATING_COLS = ["userId", "movieId", "rating", "timestamp"]


def ratings(spark, rows):
    schema = T.StructType([
        T.StructField("userId", T.LongType()), T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.IntegerType()), T.StructField("timestamp", T.LongType()),
    ])
    return spark.createDataFrame(rows, schema)


def items(spark, rows):
    """rows: (movieId, title, set_of_genres) -> cleaned item frame (int flags)."""
    schema = T.StructType(
        [T.StructField("movieId", T.LongType()), T.StructField("title", T.StringType())]
        + [T.StructField(f, T.IntegerType()) for f in ALL_FLAGS])
    data = []
    for mid, title, genres in rows:
        flags = [1 if not genres else 0] + [1 if g in genres else 0 for g in GENRES]
        data.append((mid, title, *flags))
    return spark.createDataFrame(data, schema)


def users(spark, rows):
    schema = T.StructType([
        T.StructField("userId", T.LongType()), T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()), T.StructField("occupation", T.StringType()),
        T.StructField("zipcode", T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)
