"""Delimited text sources: ratings, items and users.

Schemas are explicit, so there is no inference pass over the data and a
malformed row cannot change a column's type. Rows that do not parse are kept
in ``_corrupt`` (PERMISSIVE mode) so they can be counted, not silently lost.
Flags are read as text and cast by :func:`reelrank.operators.cleaning.cast_flags`.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelrank.functions.genres import ALL_FLAGS

CORRUPT = "_corrupt"

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])

ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("video_release_date", T.StringType()),
        T.StructField("imdb_url", T.StringType()),
    ]
    + [T.StructField(f, T.StringType()) for f in ALL_FLAGS]
)

USERS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("zipcode", T.StringType()),
])


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str,
                   name: str, encoding: str = "UTF-8") -> DataFrame:
    """Read a header-less delimited file with a fixed schema.

    A missing input fails at once with the dataset's name (S4). The check is
    Spark's own path resolution, so it sees the same file system as the
    executors, unlike a local ``os.path`` test on the driver.
    """
    try:
        return (
            spark.read.schema(_with_corrupt(schema))
            .option("sep", sep)
            .option("header", "false")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("encoding", encoding)
            .csv(path)
        )
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"input '{name}' not found: {path}") from exc
        raise


def read_ratings(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """userId, movieId, rating, timestamp (epoch seconds)."""
    return read_delimited(spark, path, RATINGS_SCHEMA, sep, "ratings")


def read_items(spark: SparkSession, path: str, sep: str = "|",
               encoding: str = "UTF-8") -> DataFrame:
    """movieId, title, three descriptive columns, 19 flags as text."""
    return read_delimited(spark, path, ITEMS_SCHEMA, sep, "items", encoding)


def read_users(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """S3: userId, age, gender, occupation, zipcode (zipcode stays text)."""
    return read_delimited(spark, path, USERS_SCHEMA, sep, "users")
