"""Text helpers for the title search, all built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separator: anything that is not a letter or a digit (Unicode aware).
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
# BM25 parameters (standard published defaults).
BM25_K1 = 1.2
BM25_B = 0.75


def tokens(text: Column | str) -> Column:
    """Lower-cased word tokens of a text, empty strings removed."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(c), TOKEN_SPLIT)
    return F.filter(parts, lambda t: F.length(t) > 0)
