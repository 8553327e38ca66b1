"""The engine's base frames derived from one source, built lazily.

A :class:`Catalog` ties the operators to a data source: cleaned ratings,
cleaned items, users, profiles. Every attribute but ``ratings_kept`` is a lazy DataFrame; nothing
runs until an action, so Catalyst sees each query as one plan and prunes and
pushes filters down to the scans.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators import cleaning, profiles
from reelrank.session import scratch_path
from reelrank.sinks import tables
from reelrank.sources import files, read_published
from reelrank.sources import starschema as star


class Catalog:
    """Frames derived from the TPC-H-like test tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.tables = star.Tables(spark, root)

    # --- raw inputs (S1-S3 equivalents) ------------------------------------
    @cached_property
    def rating_events(self) -> DataFrame:
        return star.rating_events(self.tables)

    @cached_property
    def items_raw(self) -> DataFrame:
        return star.items_raw(self.tables)

    @cached_property
    def all_users(self) -> DataFrame:
        return star.customers_as_users(self.tables)

    @cached_property
    def requests(self) -> DataFrame:
        return star.session_requests(self.tables)

    @cached_property
    def title_queries(self) -> DataFrame:
        return star.title_queries(self.tables)

    # --- cleaned facts and dimensions --------------------------------------
    @cached_property
    def ratings(self) -> DataFrame:
        return cleaning.clean_ratings(self.rating_events)

    @cached_property
    def ratings_kept(self) -> DataFrame:
        """The cleaned ratings, written once to the shared folder: for what
        reads them several times. Not lazy: the first use writes them."""
        return read_published(self.spark, tables.publish(self.ratings, scratch_path(self.spark, "ratings")))

    @cached_property
    def items(self) -> DataFrame:
        return cleaning.clean_items(self.items_raw)

    @cached_property
    def users(self) -> DataFrame:
        return cleaning.dedup_users(self.all_users)

    @cached_property
    def profiles(self) -> DataFrame:
        return profiles.user_genre_profile(self.ratings, self.items, self.users)


class FileCatalog(Catalog):
    """The same frames from delimited rating / item / user files.

    There is no request table and no title-query table (callers pass their
    own). Rows a reader could not parse are counted by :meth:`input_checks`."""

    def __init__(self, spark: SparkSession, ratings_path: str, items_path: str,
                 users_path: str | None = None, items_encoding: str = "UTF-8"):
        self.spark = spark
        self.root = None
        self.tables = None
        self._paths = (ratings_path, items_path, users_path, items_encoding)

    def input_checks(self) -> DataFrame:
        """check_name, passed, value: rows that could not be parsed in each
        input, and item flags that are neither 0 nor 1. Such rows are dropped
        or such flags nulled, so these checks inform and always pass."""
        ratings, items_path, users, encoding = self._paths
        inputs = {"corrupt_ratings": files.read_ratings(self.spark, ratings),
                  "corrupt_items": files.read_items(self.spark, items_path, encoding=encoding)}
        if users is not None:
            inputs["corrupt_users"] = files.read_users(self.spark, users)
        # A text reader parses only the columns it is asked for, so all are read along.
        counts = [df.agg(F.count(F.when(F.col(files.CORRUPT).isNotNull(), F.xxhash64(*df.columns))).alias("value"))
                  .select(F.lit(name).alias("check_name"), F.lit(True).alias("passed"), "value")
                  for name, df in inputs.items()]
        flags = cleaning.cast_flags(self.items_raw).agg(F.sum("invalid_flags").cast("long").alias("value")).select(
            F.lit("invalid_flags").alias("check_name"), F.lit(True).alias("passed"), "value")
        return reduce(DataFrame.unionByName, [*counts, flags])

    @cached_property
    def rating_events(self) -> DataFrame:
        return files.read_ratings(self.spark, self._paths[0]).drop(files.CORRUPT)

    @cached_property
    def items_raw(self) -> DataFrame:
        return files.read_items(self.spark, self._paths[1], encoding=self._paths[3]).drop(files.CORRUPT)

    @cached_property
    def all_users(self) -> DataFrame:
        if self._paths[2] is None:
            raise ValueError("this job needs a user file")
        return files.read_users(self.spark, self._paths[2]).drop(files.CORRUPT)

    @cached_property
    def requests(self) -> DataFrame:
        raise ValueError("delimited inputs have no request table: pass one (--requests)")

    @cached_property
    def title_queries(self) -> DataFrame:
        raise ValueError("delimited inputs have no title-query table: pass one (--titles)")
