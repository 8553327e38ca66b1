"""Cleaning: null drops, deterministic de-duplication, flag casts.

De-duplication is an aggregate, not a window: ``max(struct(order..., row...))``
per key keeps the latest row under a total order and is partially aggregated
before the shuffle, so a key holding a large share of the rows is combined
map-side instead of being sorted inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.genres import ALL_FLAGS

RATING_KEY = ("userId", "movieId")
# Latest first; the source tie-break columns are used when present.
RATING_ORDER = ("timestamp", "src_order", "src_line")


def drop_null_ratings(ratings: DataFrame, cols: Sequence[str] = ("rating",)) -> DataFrame:
    """P5: drop rows with a null in any of ``cols`` (and in the key)."""
    return ratings.na.drop(subset=list(RATING_KEY) + list(cols))


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A3: one row per key, the greatest by ``order`` then by the row itself.

    Columns of ``order`` that the frame does not have are skipped. The
    remaining columns break any tie, so the result never depends on input
    order or partitioning.
    """
    keys = list(keys)
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_best")
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest]).select(*df.columns)


def clean_ratings(ratings: DataFrame, keep_source_columns: bool = False) -> DataFrame:
    """P5 then A3: null ratings are dropped *before* de-duplication, so a null
    row can never hide a valid one; the latest rating per (user, item) wins."""
    out = keep_latest(drop_null_ratings(ratings), RATING_KEY, RATING_ORDER)
    if not keep_source_columns:
        out = out.select("userId", "movieId", "rating", "timestamp")
    return out


def dedup_items(items: DataFrame, key: str = "movieId") -> DataFrame:
    """A3 for items and users: one row per id. The row with the fewest invalid
    flags wins, then one with a title, then the one with the fewest nulls, then
    the smallest by all columns, so a damaged row never hides a sound one."""
    rest = [c for c in items.columns if c != key]
    damage = [F.coalesce(F.col("invalid_flags"), F.lit(0))] if "invalid_flags" in rest else []
    damage += [F.col("title").isNull().cast("int")] if "title" in rest else []
    nulls = F.expr(" + ".join(f"int(`{c}` IS NULL)" for c in rest) or "0")
    packed = F.struct(*[d.alias(f"_d{i}") for i, d in enumerate([*damage, nulls])], *[F.col(c) for c in rest])
    best = items.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(packed).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def dedup_users(users: DataFrame, key: str = "userId") -> DataFrame:
    return dedup_items(users, key)


def cast_flags(items: DataFrame, flags: Sequence[str] = ALL_FLAGS) -> DataFrame:
    """Flags to int with ``try_cast`` (ANSI-safe). Text that is not a
    number, or a number other than 0/1, becomes null and is counted in
    ``invalid_flags``. Two projections written as SQL text, so no cast is
    repeated and each projection is one call into the JVM."""
    keep = [f"`{c}`" for c in items.columns if c not in flags and not c.startswith("_")]
    casted = items.selectExpr(
        *keep,
        *[f"try_cast(trim(`{c}`) AS INT) AS `{c}`" for c in flags],
        *[f"`{c}` IS NOT NULL AS `_given_{c}`" for c in flags],
    )
    bad = " + ".join(
        f"(CASE WHEN `_given_{c}` AND NOT coalesce(`{c}` IN (0, 1), false) THEN 1 ELSE 0 END)" for c in flags)
    return casted.selectExpr(
        *keep, *[f"CASE WHEN `{c}` IN (0, 1) THEN `{c}` END AS `{c}`" for c in flags], f"{bad} AS invalid_flags")


def clean_items(items_raw: DataFrame) -> DataFrame:
    """Flags cast and one row per item."""
    return dedup_items(cast_flags(items_raw))
