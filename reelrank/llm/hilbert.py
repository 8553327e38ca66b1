"""Shards along a Hilbert curve over document metadata.

Three dimensions (source, lang, size) are quantised to ``bits`` bits each: sizes
at approximate quantiles, names by the rank of the whole name among the distinct
ones, weighted by how many texts have it. The cell's place on the Hilbert curve orders the rows,
and the curve is cut into runs of equal row counts (law ``rows``). A shard
thus covers a compact box of the metadata, so filters on any of the dimensions
can skip files. Equal texts form a group that takes the least source and lang
of its rows, so its rows stand together on the curve; a group larger than a
run is cut like anything else.

Only keys of a few dozen bytes are sorted, by range, with one offset row per
partition; texts are not shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise, partitions, summed_ranks

SHARDS = 8
BITS = 5
#: Rows equal in doc_id and text that one task puts out together.
COPIES = 100_000
#: Distinct names whose cells may be broadcast; beyond, Spark shuffles both sides.
BROADCAST_ROWS = 1_000_000


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each column of ``axes`` (dimensions x points)."""
    x = axes.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of each level, coarsest first
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> b) & 1
    return out


def _cell(value: str, cuts: str) -> Column:
    """How many quantiles are smaller."""
    return F.size(F.filter(cuts, lambda c: c < F.col(value)))


def _name_cells(groups: DataFrame, column: str, bits: int) -> DataFrame:
    """``column`` and its cell: the distinct whole names in order, cut where the
    groups before a name fill another of 2^bits equal shares."""
    names = materialise(groups.groupBy(column).agg(F.count("*").alias("n")), f"{column}-names")
    ranked = materialise(summed_ranks(names, [column]), f"{column}-ranks")
    total = F.broadcast(ranked.agg(F.sum("n").alias("total")))  # one row
    cells = ranked.crossJoin(total).select(column, F.expr(
        f"(rank + n div 2) * {1 << bits} div total").alias(f"{column}_cell"))
    return F.broadcast(cells) if ranked.count() <= BROADCAST_ROWS else cells


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """docs (doc_id, text, source, lang) -> doc_id, size, text_crc32, law,
    shard, slot, grown_shard, hilbert: every row in one of ``shards`` shards whose row
    counts are at most one apart, numbered within its shard from 0.

    Size is the text's UTF-8 bytes plus 1; null texts count as empty, null
    sources and langs as the empty name, a missing source or lang column as null.
    Ties on the curve go by the text's hash, then doc_id (null first). Rows equal in all of these are
    interchangeable. Repeated rows are rows of their own. Other columns are not read.
    """
    have = {c.lower() for c in docs.columns}
    text = F.coalesce("text", F.lit(""))
    source, lang = (F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("") for c in ("source", "lang"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"), F.xxhash64(text).alias("h"), source.alias("source"), lang.alias("lang"))
    rows = materialise(rows, "shard-keys")
    group = ["size", "crc", "h"]
    groups = materialise(rows.groupBy(*group).agg(
        F.min("source").alias("source"), F.min("lang").alias("lang")), "shard-groups")
    steps = F.lit([i / (1 << bits) for i in range(1, 1 << bits)])
    cuts = groups.agg(F.percentile_approx("size", steps, 10_000).alias("size_cuts"))
    cells = groups.join(_name_cells(groups, "source", bits), "source").join(
        _name_cells(groups, "lang", bits), "lang").crossJoin(F.broadcast(cuts)).select(  # one row of cuts
        *group, "source_cell", "lang_cell", _cell("size", "size_cuts").alias("size_cell"))

    @F.pandas_udf("long")
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a, b, c]), bits))

    placed = cells.select(*group, index("source_cell", "lang_cell", "size_cell").alias("hilbert"))
    # Rows equal in doc_id and text are one key with a count, so no range holds them row by row.
    keys = rows.groupBy("doc_id", *group).agg(F.count("*").alias("n")).join(placed, group)
    ranked = summed_ranks(keys.withColumn("known", F.col("doc_id").isNotNull()).withColumn(
        "id", F.coalesce("doc_id", F.lit(0))).drop("doc_id"), ["hilbert", "h", "crc", "size", "known", "id"])
    chunks = ranked.withColumn("at", F.explode(F.expr(f"sequence(0, n - 1, {COPIES})"))).repartition(
        partitions(docs.sparkSession), "rank", "at")
    each = chunks.withColumn("k", F.explode(F.expr(f"sequence(at, least(at + {COPIES}, n) - 1)")))
    total = F.broadcast(rows.agg(F.count("*").alias("total")))  # one row
    place = each.crossJoin(total).withColumn("place", F.col("rank") + F.col("k")).withColumn(
        "shard", F.expr(f"place * {shards} div total"))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")  # least place of the shard
    return place.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")
