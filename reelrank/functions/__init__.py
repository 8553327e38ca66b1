"""Column expressions shared by the operators (JVM-side, codegen friendly)."""

from reelrank.functions.genres import (
    ALL_FLAGS,
    GENRE_TO_PROFILE,
    GENRES,
    PROFILE_COLUMNS,
    UNKNOWN,
    genre_signature,
    mask_bit_sql,
)
from reelrank.functions.text import BM25_B, BM25_K1, tokens

__all__ = [
    "ALL_FLAGS", "GENRE_TO_PROFILE", "GENRES", "PROFILE_COLUMNS", "UNKNOWN",
    "genre_signature", "mask_bit_sql",
    "BM25_B", "BM25_K1", "tokens",
]
