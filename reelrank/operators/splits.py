"""Evaluation splits: random, hash, k-fold, leave-n-out.

Input order matters to the original scripts (they read a file top to bottom);
a DataFrame has none, so every split takes an explicit total order, by default
``timestamp, userId, movieId`` (unique once ratings are de-duplicated).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.operators.ordering import global_row_number

DEFAULT_ORDER = ("timestamp", "userId", "movieId")
# Prime modulus and multipliers of the arithmetic hash bucket. Ids are reduced
# first, so no product passes 2**40 whatever the ids.
HASH_PRIME = 1000003
HASH_USER_MULT = 7919
HASH_ITEM_MULT = 104729
#: Ratings of one range of :func:`evaluation_sets`: a task sorts so many for every set.
RANGE_ROWS = 400_000


def split_random(ratings: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> DataFrame:
    """X1 as the original: ``randomSplit``; rows labelled 'train' / 'test'.
    The draw depends on partitioning; see :func:`split_hash` for a stable one."""
    train, test = ratings.randomSplit(list(weights), seed=seed)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def hash_bucket(buckets: int = 100):
    """Stable bucket of a (user, item) pair, same under any partitioning."""
    prime = F.lit(HASH_PRIME).cast("long")
    mix = (F.pmod(F.col("userId").cast("long"), prime) * HASH_USER_MULT
           + F.pmod(F.col("movieId").cast("long"), prime) * HASH_ITEM_MULT) % prime
    return (mix * mix % prime) % buckets  # the square breaks the lattice of the linear form


def split_hash(ratings: DataFrame, train_percent: int = 80) -> DataFrame:
    """X1, deterministic: 'train' when the pair's bucket (0..99) is below
    ``train_percent``, else 'test'."""
    return ratings.withColumn(
        "split", F.when(hash_bucket(100) < train_percent, "train").otherwise("test"))


def kfold_split(ratings: DataFrame, k: int = 5, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """Rows in ``order`` cut into ``k`` contiguous, balanced ranges; adds
    ``fold`` (1..k), the fold whose test set holds the row. Fold i's base set
    is every row with another fold. Every fold is non-empty when n >= k."""
    numbered = global_row_number(ratings, order, "_rn")
    total = numbered.agg(F.count("*").alias("_total"))
    fold = F.expr(f"CAST((_rn - 1) * {k} div _total + 1 AS INT)")
    return numbered.crossJoin(F.broadcast(total)).select(*ratings.columns, fold.alias("fold"))


def _first_rows(ratings: DataFrame, stop: int, order: Sequence[str]) -> DataFrame:
    """Each user's first ``stop`` rows in ``order``, numbered from 1 by ``_n``."""
    by_user = Window.partitionBy("userId").orderBy(*[c for c in order if c != "userId"])
    return ratings.withColumn("_n", F.row_number().over(by_user)).filter(F.col("_n") <= stop)


def leave_n_out(ratings: DataFrame, start: int = 1, stop: int = 10, max_test: int = 0,
                order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """A user's ratings number ``start``..``stop`` (in ``order``) go to
    'test', the rest to 'base'. Off unless asked for: ``max_test > 0`` caps the
    test rows in total, keeping the earliest in ``order``.

    Per-user numbering only needs each user's first ``stop`` rows, so Spark
    limits every user to ``stop`` rows before the shuffle (WindowGroupLimit);
    a user holding a large share of the data costs no more than any other."""
    test = _first_rows(ratings, stop, order).filter(F.col("_n") >= start).drop("_n")
    if max_test > 0:
        test = global_row_number(test, order, "_g").filter(F.col("_g") <= max_test).drop("_g")
    keys = test.select("userId", "movieId").withColumn("_test", F.lit(True))
    labelled = ratings.join(keys, ["userId", "movieId"], "left")
    return labelled.select(
        *ratings.columns, F.when(F.col("_test"), "test").otherwise("base").alias("part"))


def evaluation_sets(ratings: DataFrame, k: int = 5, n: int = 10) -> DataFrame:
    """Every base/test pair of the evaluation scripts in one frame: ``set_name``
    (``u1`` .. ``uk`` for the folds, ``ua`` and ``ub`` for a user's ratings 1..n
    and n+1..2n as test), ``part`` ('base' / 'test'), and the rating.

    Every rating is labelled once for all sets (its fold and its number among its
    user's first ``2n``); the labelled rows are laid into ranges of (userId,
    movieId) and only then repeated for each set, so no shuffle carries the
    repeats. Expects one rating for each (userId, movieId)."""
    cols = ratings.columns
    folds = kfold_split(ratings, k)
    numbers = _first_rows(folds, 2 * n, DEFAULT_ORDER).select("userId", "movieId", "_n")
    ranges = max(ratings.sparkSession.sparkContext.defaultParallelism, -(-folds.count() // RANGE_ROWS))
    labelled = folds.join(numbers, ["userId", "movieId"], "left").repartitionByRange(ranges, "userId", "movieId")
    tests = {f"u{i}": F.col("fold") == i for i in range(1, k + 1)}
    tests |= {name: F.coalesce(F.col("_n").between(start, start + n - 1), F.lit(False))
              for name, start in (("ua", 1), ("ub", n + 1))}
    sets = F.array(*[F.struct(F.lit(name).alias("set_name"), F.when(test, "test").otherwise("base").alias("part"))
                     for name, test in tests.items()])
    return labelled.select(F.inline(sets), *cols)
