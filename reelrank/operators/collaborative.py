"""Collaborative filtering with Spark ML's ALS (M1-M4).

ALS is already a distributed, blocked algorithm: user and item factors are
partitioned into blocks and each iteration shuffles factor blocks, never
ratings to the driver. The training frame is persisted once because the fit
passes over it several times (the original recomputed the whole read and
clean plan for split, fit and predict).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.inner_products import top_products

# --- fixed values -----------------------------------------------------------
# Training settings of the original job.
ALS_MAX_ITER = 10
ALS_REG_PARAM = 0.1
ALS_NONNEGATIVE = True
ALS_COLD_START = "drop"
SPLIT_SEED = 42
TOP_K = 10
#: Spark's default number of blocks of users and of items. That of users decides
#: the random start.
BLOCKS = 10
#: More ratings than so many for each block get more blocks. A task builds a block in one
#: piece: about 36 bytes of heap for each of its ratings at the worst moment, more beyond 2^24.
RATINGS_A_BLOCK = 15_000_000
#: Blocks and factors stay on disk: in the heap they would stand beside those being built.
STORED = "DISK_ONLY"
#: The shuffle files of earlier iterations go after every so many.
CHECKPOINT_EVERY = 2
#: Every iteration sends a user's factors to each block of items that the user
#: rated, so fewer blocks of items shuffle less, on fewer cores. Their number changes
#: results by rounding only: the first step makes all item factors from the users' start.
FEW_ITEM_BLOCKS = 3
# --- end of fixed values ----------------------------------------------------


def fit_als(train: DataFrame, rank: int = 10, max_iter: int = ALS_MAX_ITER,
            reg_param: float = ALS_REG_PARAM, seed: int = SPLIT_SEED,
            blocks: int | None = None, item_blocks: int | None = None) -> ALSModel:
    """M1: fit ALS on (userId, movieId, rating). Ids must fit in 32 bits
    (ALS refuses larger ones with a clear error). Other numbers of user
    ``blocks`` start from other random factors; not given, they follow the
    number of ratings; ``item_blocks``: as many if not given."""
    data = train.select("userId", "movieId", F.col("rating").cast("float").alias("rating"))
    data = data.persist(StorageLevel.DISK_ONLY)
    try:
        if blocks is None:
            blocks = max(BLOCKS, -(-data.count() // RATINGS_A_BLOCK))
        als = ALS(
            userCol="userId", itemCol="movieId", ratingCol="rating",
            rank=rank, maxIter=max_iter, regParam=reg_param,
            nonnegative=ALS_NONNEGATIVE, coldStartStrategy=ALS_COLD_START, seed=seed,
            numUserBlocks=blocks, numItemBlocks=item_blocks or blocks,
            intermediateStorageLevel=STORED, finalStorageLevel=STORED, checkpointInterval=CHECKPOINT_EVERY,
        )
        return als.fit(data)
    finally:
        data.unpersist()


def als_predictions(model: ALSModel, test: DataFrame) -> DataFrame:
    """M2: userId, movieId, rating, prediction; pairs with an unseen user or
    item are dropped (cold-start 'drop')."""
    return model.transform(test.select("userId", "movieId", "rating")).select(
        "userId", "movieId", "rating", "prediction")


def als_recommendations(model: ALSModel, k: int = TOP_K, exclude: DataFrame | None = None) -> DataFrame:
    """M4: top ``k`` items per user, long form: userId, rank, movieId,
    rating (predicted), without the (userId, movieId) pairs of ``exclude``.

    Exact; bounds end a user's scan of the items (see
    :mod:`reelrank.operators.inner_products`). Ties go to the lower id."""
    lists = top_products(model.userFactors, model.itemFactors, k, exclude)
    return lists.select("userId", F.posexplode(F.arrays_zip("ids", "scores")).alias("pos", "rec")).select(
        "userId", (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("rec.ids").alias("movieId"), F.col("rec.scores").alias("rating"))


def long_recommendations(nested: DataFrame) -> DataFrame:
    """The nested lists of :func:`nested_recommendations` as rows."""
    return nested.select("userId", F.posexplode("recommendations").alias("pos", "rec")).select(
        F.col("userId").cast("long").alias("userId"),
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("rec.movieId").cast("long").alias("movieId"),
        F.col("rec.rating").alias("rating"),
    )


def nested_recommendations(model: ALSModel, k: int = TOP_K) -> DataFrame:
    """M4 as the original publishes it: userId, array<struct<movieId, rating>>."""
    return model.recommendForAllUsers(k)


def als_recommendations_unseen(model: ALSModel, seen: DataFrame, k: int = TOP_K) -> DataFrame:
    """M4 with ``exclude_seen``: the top ``k`` items a user has *not* rated,
    for every user of the model."""
    return als_recommendations(model, k, seen.select("userId", "movieId"))
