"""Exact top k inner products of every user with all items, pruned by bounds.

Items are numbered by falling norm and read in chunks. A user's scan ends as
soon as no later item can enter the user's list: an inner product is at most
|user| times the next norm (Cauchy-Schwarz), and at most the product with the
greatest (for negative components: least) value that any later item has in each
component; the lesser of both bounds counts. Both bounds and the excluded items are
applied inside the one pass, so a user with a long history costs no longer list.

The first chunk holds ``FIRST_ITEMS``, each later one twice as many until a chunk
reaches ``CHUNK_BYTES``, its proven size wherever it is held (driver, broadcast).
Users whose scan has ended leave after each chunk; the others are
written to the shared folder and go on. Excluded pairs reach a task as
positions in the current chunk, so no array outgrows a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.ordering import global_row_number
from reelrank.session import cut_lineage

FIRST_ITEMS = 65_536
CHUNK_BYTES = 64 << 20
#: Items and users that meet in one matrix product.
ITEM_BLOCK, USER_BLOCK = 256, 1024
#: Room for rounding: scores are rounded to 32 bits before they are compared with a bound.
_SLACK = 1e-5
_NO_ID = np.iinfo(np.int64).max

_STATE = "userId long, features array<float>, ids array<long>, scores array<float>, n_scored long, done boolean"


def chunk_borders(n_items: int, rank: int, first: int = FIRST_ITEMS, chunk_bytes: int = CHUNK_BYTES) -> list[int]:
    """0 = first border < ... < last border = ``n_items``."""
    most = max(1, chunk_bytes // (8 * rank + 16))
    borders, size = [0], min(first, most)
    while borders[-1] < n_items:
        borders.append(min(n_items, borders[-1] + size))
        size = min(2 * size, most)
    return borders


class Chunk:
    """Items lo..hi in order of falling norm, with bounds on all that follow each block."""

    def __init__(self, ids: np.ndarray, factors: np.ndarray, tail: tuple[np.ndarray, np.ndarray, float] | None):
        self.ids, self.factors = ids, factors
        norms = np.sqrt((factors ** 2).sum(1))
        self.blocks = [(a, min(a + ITEM_BLOCK, len(ids))) for a in range(0, len(ids), ITEM_BLOCK)]
        self.after: list[tuple[np.ndarray, np.ndarray, float] | None] = []
        for a, b in reversed(self.blocks):
            self.after.append(tail)
            high, low, norm = factors[a:b].max(0), factors[a:b].min(0), float(norms[a:b].max())
            if tail is not None:
                high, low, norm = np.maximum(high, tail[0]), np.minimum(low, tail[1]), max(norm, tail[2])
            tail = high, low, norm
        self.after.reverse()

    def scan(self, users: np.ndarray, ids: np.ndarray, scores: np.ndarray,
             skip: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Fold the chunk into the lists ``ids`` and ``scores`` (in place; users x k).

        ``skip``: user rows and positions of the excluded pairs, by position.
        Returns the items scored for each user and whether the scan has ended."""
        k, norms = ids.shape[1], np.sqrt((users ** 2).sum(1))
        scored, done = np.zeros(len(users), np.int64), np.zeros(len(users), bool)
        place = np.full(len(users), -1)
        for (a, b), rest in zip(self.blocks, self.after):
            open_ = np.flatnonzero(~done)
            if not len(open_):
                break
            place[:] = -1
            place[open_] = np.arange(len(open_))
            s = (users[open_] @ self.factors[a:b].T).astype(np.float32)
            scored[open_] += b - a
            lo, hi = np.searchsorted(skip[1], [a, b])
            rows, cols = place[skip[0][lo:hi]], skip[1][lo:hi] - a
            s[rows[rows >= 0], cols[rows >= 0]] = -np.inf
            better = np.flatnonzero((s >= scores[open_, -1][:, None]).any(1))
            if len(better):
                at = open_[better]
                every = np.concatenate([scores[at], s[better]], axis=1)
                names = np.concatenate([ids[at], np.broadcast_to(self.ids[a:b], (len(at), b - a))], axis=1)
                names = np.where(np.isneginf(every), _NO_ID, names)
                order = np.lexsort((names, -every), axis=-1)[:, :k]
                scores[at], ids[at] = np.take_along_axis(every, order, 1), np.take_along_axis(names, order, 1)
            if rest is None:
                done[:] = True
                break
            high, low, norm = rest
            u = users[open_]
            bound = np.minimum(norms[open_] * norm, np.maximum(u, 0) @ high + np.minimum(u, 0) @ low)
            done[open_] = scores[open_, -1] > bound + _SLACK * np.abs(bound)
        return scored, done


def _bounds(numbered: DataFrame, borders: list[int], rank: int) -> list[tuple[np.ndarray, np.ndarray, float] | None]:
    """For each chunk: greatest and least components and greatest norm of all later chunks."""
    chunk = F.lit(0)
    for border in borders[1:-1]:
        chunk = chunk + (F.col("pos") > border).cast("int")
    rows = numbered.groupBy(chunk.alias("chunk")).agg(
        F.max("norm").alias("norm"), *[F.max(F.col("features")[i]).alias(f"h{i}") for i in range(rank)],
        *[F.min(F.col("features")[i]).alias(f"l{i}") for i in range(rank)]).orderBy("chunk").collect()  # one a chunk
    out, tail = [], None
    for r in reversed(rows):
        out.append(tail)
        high = np.array([r[f"h{i}"] for i in range(rank)], float)
        low = np.array([r[f"l{i}"] for i in range(rank)], float)
        norm = r["norm"]
        if tail is not None:
            high, low, norm = np.maximum(high, tail[0]), np.minimum(low, tail[1]), max(norm, tail[2])
        tail = high, low, norm
    return out[::-1]


def top_products(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None,
                 first: int = FIRST_ITEMS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The ``k`` items of greatest inner product with each user.

    ``users`` and ``items``: id, features (arrays of one length, ids unique);
    ``seen``: userId, movieId pairs to leave out (unknown ids and repeated pairs are
    harmless). Returns userId, ids, scores (32-bit, falling; ties by id) and
    n_scored, the number of items whose product was computed for the user. A user
    with fewer than ``k`` items left has shorter arrays.
    """
    spark = users.sparkSession
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    numbered = cut_lineage(global_row_number(
        items.select(F.col("id").cast("long").alias("id"), "features", norm.alias("norm")), [F.desc("norm"), "id"], "pos"))
    size = numbered.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("rank")).first()
    state = users.select(
        F.col("id").cast("long").alias("userId"), F.col("features").cast("array<float>").alias("features"),
        F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("scores"),
        F.lit(0).cast("long").alias("n_scored"), F.lit(size["n"] == 0).alias("done"))
    lists = ["userId", "ids", "scores", "n_scored"]
    if not size["n"]:
        return state.select(lists)
    borders = chunk_borders(size["n"], size["rank"], first, chunk_bytes)
    tails = _bounds(numbered, borders, size["rank"])
    if seen is not None:
        places = numbered.select(F.col("id").alias("movieId"), "pos")
        seen = cut_lineage(seen.select(F.col("userId").cast("long").alias("userId"), F.col("movieId").cast("long").alias("movieId"))
                           .distinct().join(places, "movieId").select("userId", "pos"))
    finished = None
    # An explicit count: a user's row is small and its scan long, so tasks must not be merged by bytes.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for lo, hi, tail in zip(borders, borders[1:], tails):
        rows = numbered.filter((F.col("pos") > lo) & (F.col("pos") <= hi)).orderBy("pos").select("id", "features").collect()
        chunk = spark.sparkContext.broadcast(Chunk(
            np.array([r["id"] for r in rows], np.int64), np.array([r["features"] for r in rows], float), tail))
        if seen is None:
            asked = state.repartition(n, "userId").withColumn("skip", F.array().cast("array<int>"))
        else:
            here = seen.filter((F.col("pos") > lo) & (F.col("pos") <= hi)).repartition(n, "userId").groupBy("userId").agg(
                F.collect_list((F.col("pos") - lo - 1).cast("int")).alias("skip"))
            asked = state.repartition(n, "userId").join(here, "userId", "left").withColumn("skip", F.coalesce("skip", F.array().cast("array<int>")))

        def scan(batches: Iterator[pd.DataFrame], chunk=chunk) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), USER_BLOCK):
                    yield _scan_users(chunk.value, batch.iloc[at:at + USER_BLOCK], k)

        after = cut_lineage(asked.mapInPandas(scan, _STATE))
        chunk.unpersist()
        ended = after.filter("done").select(lists)
        finished = ended if finished is None else finished.unionByName(ended)
        state = after.filter("NOT done")
        if state.isEmpty():
            break
    return finished


def _scan_users(chunk: Chunk, part: pd.DataFrame, k: int) -> pd.DataFrame:
    """One block of users after one chunk."""
    n = len(part)
    ids, scores = np.full((n, k), _NO_ID, np.int64), np.full((n, k), -np.inf, np.float32)
    for i, (a, b) in enumerate(zip(part["ids"], part["scores"])):
        ids[i, :len(a)], scores[i, :len(b)] = a, b
    lengths = np.array([len(x) for x in part["skip"]], np.int64)
    rows = np.repeat(np.arange(n), lengths)
    cols = np.concatenate([np.asarray(x, np.int64) for x in part["skip"]])
    order = np.argsort(cols, kind="stable")
    scored, done = chunk.scan(np.stack(part["features"].to_numpy()).astype(float), ids, scores, (rows[order], cols[order]))
    real = ids != _NO_ID
    return pd.DataFrame({
        "userId": part["userId"].to_numpy(), "features": list(part["features"]),
        "ids": [i[r] for i, r in zip(ids, real)], "scores": [s[r] for s, r in zip(scores, real)],
        "n_scored": part["n_scored"].to_numpy() + scored, "done": done})
