"""Sources: delimited rating/item/user files, published tables, and the
adapter that derives the same model from the TPC-H-like test tables."""

from reelrank.sources.files import (
    ITEMS_SCHEMA,
    RATINGS_SCHEMA,
    USERS_SCHEMA,
    read_items,
    read_ratings,
    read_users,
)
from reelrank.sources.published import read_published
from reelrank.sources.starschema import Tables

__all__ = [
    "ITEMS_SCHEMA", "RATINGS_SCHEMA", "USERS_SCHEMA", "read_items",
    "read_ratings", "read_users", "read_published", "Tables",
]
