"""Genre-weighted top-k ranking of every item for every user (R1, R2 scorer).

score(user, item) = 1.0 + sum over genres g of weight(user, g) * flag(item, g)

summed in the fixed genre order and rounded to 6 places before ranking; ties
go to the lower ``movieId``. Seen items are not excluded (as in the original).

Plan, exact and linear in users:

1. An item's score depends only on its genre mask (18 bits, so at most 2**18
   masks, whatever the data size). Per mask keep the ``k`` smallest ids
   (``row_number <= k``; Spark applies the limit before and after the shuffle,
   so a mask holding a large share of all items is cut map-side).
   Of these the k-skyband is marked (:func:`skyband`): an item is out for every
   user with weights of zero or more if ``k`` items of smaller id have all of its
   genres. Adding a term of zero or more never lowers a rounded sum, so those ``k``
   items score as high and win the tie.
2. The mask table has a proven size bound (2**18 rows of at most k ids),
   so it is broadcast and every user row is scored against the masks of the skyband
   (users with a negative or infinite weight: all masks) in one codegen'd projection. Users are
   range-partitioned by id first (one small row each), so the scored rows
   are already clustered and ``row_number <= k`` per user needs no shuffle:
   each task sorts only its own users' rows, spilling if needed.
3. Each mask carries its ``k`` smallest ids as an array (at most 2**18 x k
   longs in the broadcast), so a user's best masks are expanded in the same task
   (at most ``k * k`` rows) and ``row_number <= k`` by (score desc, id asc) ends
   there: no row is ever shuffled by mask. Titles are joined last, by id.

Why it is exact: if mask A ranks before mask B, A's smallest item ranks before
every item of B. A mask outside a user's best ``k`` has ``k`` masks before it,
each giving an item before all of its items, so none of them can be in the
top ``k``; inside a mask only the id decides, so its ``k`` smallest suffice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.functions.genres import GENRES, PROFILE_COLUMNS, genre_signature, mask_bit_sql

SCORE_DIGITS = 6
BASE_SCORE = 1.0


def score_sql(weight_cols: Sequence[str], mask: str) -> str:
    """SQL text of ``round(1.0 + sum_i w_i * bit_i(mask), 6)``, terms added
    left to right in genre order, a null weight counting as 0."""
    terms = "".join(
        f" + coalesce(CAST(`{w}` AS DOUBLE), 0.0D) * {mask_bit_sql(mask, i)}" for i, w in enumerate(weight_cols))
    return f"round({BASE_SCORE}D{terms}, {SCORE_DIGITS})"


def mask_items(items: DataFrame, k: int) -> DataFrame:
    """(mask, movieId, title, pos): the k smallest ids of every genre mask."""
    with_mask = items.select("movieId", "title", genre_signature().alias("mask"))
    w = Window.partitionBy("mask").orderBy("movieId")
    return with_mask.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)


def mask_table(kept: DataFrame) -> DataFrame:
    """(mask, ids) of every mask present, its kept ids in ascending order: at
    most 2**18 rows of at most k ids."""
    return kept.groupBy("mask").agg(F.array_sort(F.collect_list("movieId")).alias("ids"))


def superset_limits(masks: np.ndarray, ranks: np.ndarray, bits: int) -> np.ndarray:
    """For each mask, the k-th smallest rank among its own and its supersets'
    (``ranks``: a row of k for each mask, missing ones as the type's greatest).

    The k smallest of all supersets are gathered bit by bit over the lattice of
    masks: after bit i, a place holds those of the masks that add any of the
    first i bits. Time and memory depend on ``bits`` and k alone.
    """
    k = ranks.shape[1]
    table = np.full((1 << bits, k), np.iinfo(ranks.dtype).max, ranks.dtype)
    table[masks] = ranks
    for i in range(bits):
        without, having = np.moveaxis(table.reshape(-1, 2, 1 << i, k), 1, 0)
        both = np.concatenate([without, having], axis=-1)
        without[:] = np.partition(both, k - 1, axis=-1)[..., :k]
    return table[masks].max(axis=1)


def skyband(masks: DataFrame, k: int, bits: int = len(GENRES)) -> DataFrame:
    """(mask, ids) -> mask, ids, keep: the first ``keep`` ids of a mask lie in the
    k-skyband, i.e. fewer than ``k`` ids of the mask and its supersets are smaller.

    The table is bounded by 2**bits rows of k ids whatever the data, so one task
    sees all of it."""
    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["ids"].map(len).to_numpy()
        values, ranks = np.unique(np.concatenate(pdf["ids"].to_list()), return_inverse=True)
        rows = np.full((len(pdf), k), np.iinfo(np.int32).max, np.int32)
        rows[np.arange(k) < sizes[:, None]] = ranks
        inside = (rows <= superset_limits(pdf["mask"].to_numpy(), rows, bits)[:, None]) & (rows < len(values))
        return pdf.assign(keep=inside.sum(axis=1).astype(np.int32))

    return masks.select("mask", "ids").groupBy().applyInPandas(mark, "mask int, ids array<long>, keep int")


def monotone_sql(weight_cols: Sequence[str]) -> str:
    """SQL text: no weight is negative, infinite or not a number (null counts as 0)."""
    return " AND ".join(f"coalesce(CAST(`{w}` AS DOUBLE), 0.0D) >= 0 AND "
                        f"coalesce(CAST(`{w}` AS DOUBLE), 0.0D) < double('infinity')" for w in weight_cols)


def top_k_by_genre_weights(weights: DataFrame, id_col: str, weight_cols: Sequence[str],
                           items: DataFrame, k: int = 10, partitions: int | None = None) -> DataFrame:
    """Top ``k`` items per row of ``weights`` (id_col + one weight per genre,
    in genre order; null counts as 0). Returns id_col, rank, movieId, title,
    score.

    The rows are range-partitioned by ``id_col`` into ``partitions``
    (default ``spark.sql.shuffle.partitions``) before the product: a shuffle
    of one row per id that already clusters ids, so the per-id windows never
    shuffle the much larger id x mask product. The count is explicit, and
    range (not hash) partitioning is used, because the id rows are small: a
    hash repartition would be merged into the upstream aggregate's exchange,
    which adaptive execution then coalesces into a few partitions, leaving
    the product, the real work, to a few tasks."""
    if len(weight_cols) != len(GENRES):
        raise ValueError(f"need {len(GENRES)} weight columns, got {len(weight_cols)}")
    kept = mask_items(items, k)
    n = partitions or int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = weights.select(id_col, *weight_cols).repartitionByRange(n, id_col)
    rows = rows.withColumn("_monotone", F.expr(monotone_sql(weight_cols)))
    # Broadcast of a table bounded by 2**18 rows, independent of data size.
    masks = F.broadcast(skyband(mask_table(kept), k))
    scored = rows.join(masks, (F.col("keep") > 0) | ~F.col("_monotone")).select(
        id_col, F.expr("CASE WHEN _monotone THEN slice(ids, 1, keep) ELSE ids END AS ids"),
        F.expr(score_sql(weight_cols, "mask")).alias("score"))
    by_mask = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("ids")[0].asc())
    best = scored.withColumn("_r", F.row_number().over(by_mask)).filter(F.col("_r") <= k)
    cand = best.select(id_col, "score", F.explode("ids").alias("movieId"))
    order = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("movieId").asc())
    ranked = cand.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = ranked.join(kept.select("movieId", "title"), "movieId")
    return named.select(id_col, F.col("rank").cast("int").alias("rank"), "movieId", "title", "score")


def recommend_known(profiles: DataFrame, items: DataFrame, k: int = 10,
                    profile_cols: Sequence[str] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """Top ``k`` items for every profiled user by their genre averages.

    A genre counts only when the user's average is present and non-zero."""
    cols = list(profile_cols or PROFILE_COLUMNS)
    weights = profiles.selectExpr(
        "userId", *[f"CASE WHEN `{c}` IS NOT NULL AND `{c}` <> 0 THEN `{c}` END AS `{c}`" for c in cols])
    return top_k_by_genre_weights(weights, "userId", cols, items, k, partitions)
