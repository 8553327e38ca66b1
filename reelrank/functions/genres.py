"""The canonical genre vocabulary and column expressions over genre flags.

One list serves items, profiles and queries, so every genre counts in every
step (the original spelled two genres differently in different places).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Genre flag columns of the item table, in the order of the source data.
GENRES = [
    "action", "adventure", "animation", "children", "comedy", "crime",
    "documentary", "drama", "fantasy", "film_noir", "horror", "musical",
    "mystery", "romance", "sci_fi", "thriller", "war", "western",
]
# The extra flag that marks an item with no known genre.
UNKNOWN = "unknown"
# Column names of the published user profile, same order as GENRES.
PROFILE_COLUMNS = [
    "avg_action", "avg_adventure", "avg_animation", "avg_children",
    "avg_comedy", "avg_crime", "avg_documentary", "avg_drama", "avg_fantasy",
    "avg_filmnoir", "avg_horror", "avg_musical", "avg_mystery", "avg_romance",
    "avg_scifi", "avg_thriller", "avg_war", "avg_western",
]
# --- end of fixed values ----------------------------------------------------

ALL_FLAGS = [UNKNOWN] + GENRES
GENRE_TO_PROFILE = dict(zip(GENRES, PROFILE_COLUMNS))


def genre_signature(prefix: str = "") -> Column:
    """18-bit mask of an item's genres: bit i is set when GENRES[i] is 1.

    Items with equal masks score equally under any genre-weighted scorer, and
    there are at most 2**18 masks, a bound that does not grow with the data.
    Built as one SQL expression (one call into the JVM, not one per term).
    """
    bits = " | ".join(f"(CASE WHEN `{prefix}{g}` = 1 THEN {1 << i} ELSE 0 END)" for i, g in enumerate(GENRES))
    return F.expr(f"CAST({bits} AS INT)")


def mask_bit_sql(mask: str, i: int) -> str:
    """SQL text: 1 when bit ``i`` of the mask column is set, else 0."""
    return f"(shiftright(`{mask}`, {i}) & 1)"
