"""Product codes of vectors, with LAESA pivots in the nearest-entry search.

A vector's components become integers, ``floor(scale * x)``, and it is cut into
equal parts; each part position has a codebook of ``entries`` integer vectors,
moved by ``rounds`` of assignment and floor-averaging, all in exact integer
arithmetic.

The nearest entry is found by LAESA. Some parts stay fixed as pivots. The
distance of every part to every pivot is computed once and stored beside it.
In each round only the pivots' distances to the entries are new (a few
thousand numbers); for a part x and an entry e, |d(x, p) - d(e, p)| over the
pivots p bounds d(x, e) from below. The entries of least bound are measured
exactly first; an entry whose bound is beyond the best so far is never
measured. Bounds are floating-point and taken smaller by more than their
error, so no nearest entry and no tie is lost; distances are exact integers.

Codebooks, pivots and their distances are the only shared state: their size
depends on ``entries`` and the dimension, not on the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise

PARTS, ENTRIES, ROUNDS, PIVOTS, SCALE = 4, 256, 4, 12, 1024
#: Entries that are measured before the first pruning, and vectors taken together in a task.
FIRST, BLOCK = 6, 512
#: Labels whose sums may be broadcast; beyond, the join is left to a shuffle.
BROADCAST_ROWS = 1_000_000
#: Relative error allowed for in stored distances (32-bit) and their differences.
_SLACK = 1e-6


@dataclass
class Codebooks:
    """``entries`` (parts, entries, width) and what LAESA keeps of the fixed pivots."""

    entries: np.ndarray
    pivots: np.ndarray  # (parts, pivots, width)

    def reach(self) -> np.ndarray:
        """Distances of the entries to the pivots: (parts, entries, pivots)."""
        return np.stack([_distances(e, p) for e, p in zip(self.entries, self.pivots)])

    def digest(self) -> str:
        """sha256 of all components in decimal, by part, entry and place, comma between."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of two integer tables, from exact squares."""
    gap = a[:, None, :] - b[None, :, :]
    return np.sqrt(np.einsum("ijk,ijk->ij", gap, gap).astype(np.float64))


def choose_pivots(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """``n`` parts far from each other: each the one farthest from those before
    it (ties: the first), beginning with the one farthest from the mean."""
    out = []
    for part in entries:
        gap = _distances(part, np.floor(part.mean(axis=0, keepdims=True)).astype(np.int64))[:, 0]
        picked = []
        for _ in range(min(n, len(part))):
            picked.append(int(gap.argmax()))
            near = _distances(part, part[picked[-1]][None])[:, 0]
            gap = near if len(picked) == 1 else np.minimum(gap, near)
        out.append(part[picked])
    return np.stack(out)


def nearest(parts: np.ndarray, reach: np.ndarray, entries: np.ndarray,
            entry_reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each part (rows of integers, with their pivot distances) the nearest
    entry, the lower index among equals; its squared distance; and how many
    distances were measured."""
    n, k = len(parts), len(entries)
    bound = np.zeros((n, k), np.float32)
    for p in range(entry_reach.shape[1]):
        np.maximum(bound, np.abs(reach[:, p, None] - entry_reach[None, :, p].astype(np.float32)), out=bound)
    # what rounding of either distance may have added
    bound -= np.float32(_SLACK) * (reach.max(axis=1)[:, None] + np.float32(entry_reach.max())) + np.float32(1e-3)

    def measured(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        gap = parts[rows] - entries[cols]
        return np.einsum("ij,ij->i", gap, gap)

    first = min(FIRST, k)
    cols = np.argpartition(bound, first - 1, axis=1)[:, :first] if first < k else np.tile(np.arange(k), (n, 1))
    exact = measured(np.repeat(np.arange(n), first), cols.ravel()).reshape(n, first)
    best = exact.min(axis=1)
    code = np.where(exact == best[:, None], cols, k).min(axis=1)
    total = n * first
    # float64 of the square root rounded up: an equal distance must pass
    limit = np.nextafter(np.sqrt(best.astype(np.float64)) * (1 + 1e-12), np.inf)
    open_ = bound <= limit[:, None].astype(np.float32) * np.float32(1 + _SLACK)
    np.put_along_axis(open_, cols, False, axis=1)
    rows, cols = open_.nonzero()
    if len(rows):
        exact = measured(rows, cols)
        total += len(rows)
        # by row, then distance, then index: the first of a row is its answer
        order = np.lexsort((cols, exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        head = np.concatenate([[True], rows[1:] != rows[:-1]])
        rows, cols, exact = rows[head], cols[head], exact[head]
        better = (exact < best[rows]) | ((exact == best[rows]) & (cols < code[rows]))
        best[rows[better]], code[rows[better]] = exact[better], cols[better]
    return code, best, total


def _magnitude(width: int) -> int:
    """Greatest component for which squared distances of ``width`` components
    fit in 62 bits: components beyond are taken as this one."""
    return 1 << (62 - max(width, 1).bit_length()) // 2 - 1


def _integers(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each vector, zeros behind shorter ones."""
    limit = float(_magnitude(width))
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.clip(np.floor(scale * np.asarray(v, np.float64)), -limit, limit)
    return out


def _usable(column: str):
    """Not null, and no component null, NaN or infinite."""
    x = F.col(column).cast("array<double>")
    return F.col(column).isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def _tables(vectors: pd.Series, parts: int) -> np.ndarray:
    """(vectors, parts, width) of the stored integers."""
    flat = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, parts), np.int64)
    return flat.reshape(len(flat), parts, -1)


def prepare(vectors: DataFrame, parts: int, scale: int, entries: int, pivots: int) -> tuple[DataFrame, Codebooks | None]:
    """The usable vectors as integers with their pivot distances (vec_id,
    label, x, reach), written once, and the first codebooks; None without vectors."""
    kept = vectors.filter(_usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    width = max(1, -(-(longest or 0) // parts)) * parts
    # ascending vec_id, null last; rows of one vec_id by their components
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # bounded by entries
    if not start:
        return kept.select("vec_id", "label"), None
    first = _integers(pd.Series([r["v"] for r in start]), width, scale).reshape(len(start), parts, -1).transpose(1, 0, 2)
    books = Codebooks(np.ascontiguousarray(first), choose_pivots(first, pivots))

    def to_table(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _integers(batch, width, scale)
            cut = x.reshape(len(x), parts, -1)
            reach = np.concatenate([_distances(cut[:, p], books.pivots[p]) for p in range(parts)], axis=1)
            yield pd.DataFrame({"x": list(x), "reach": list(reach.astype(np.float32))})

    udf = F.pandas_udf(to_table, "x array<long>, reach array<float>")
    return materialise(kept.select("vec_id", "label", udf("v").alias("r")).select(
        "vec_id", "label", "r.x", "r.reach"), "vector-parts"), books


def _assigned(x: pd.Series, reach: pd.Series, books: Codebooks, entry_reach: np.ndarray):
    """(integers, codes, squared distances, distances measured) of blocks of rows."""
    parts = len(books.entries)
    for at in range(0, len(x), BLOCK):
        ints = _tables(x.iloc[at:at + BLOCK], parts)
        held = np.stack(reach.iloc[at:at + BLOCK].to_numpy()).reshape(len(ints), parts, -1)
        found = [nearest(ints[:, p], held[:, p], books.entries[p], entry_reach[p]) for p in range(parts)]
        yield (ints, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1),
               sum(f[2] for f in found))


def moved(table: DataFrame, books: Codebooks) -> tuple[Codebooks, int]:
    """One round: parts assigned, entries replaced by the floor of their parts'
    mean, unused ones kept. Also the number of distances measured. A task sends
    one row for each entry it used."""
    parts, k, width = books.entries.shape

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entry_reach, total = books.reach(), 0
        count, added = np.zeros(parts * k, np.int64), np.zeros((parts * k, width), np.int64)
        for pdf in batches:
            for ints, codes, _, n in _assigned(pdf["x"], pdf["reach"], books, entry_reach):
                slot = (codes + k * np.arange(parts)).ravel()
                count += np.bincount(slot, minlength=parts * k)
                np.add.at(added, slot, ints.reshape(len(slot), width))
                total += n
        used = np.flatnonzero(count)
        yield pd.DataFrame({"slot": used, "n": count[used], "s": list(added[used]),
                            "measured": np.where(np.arange(len(used)) == 0, total, 0)})

    found = table.select("x", "reach").mapInPandas(sums, "slot int, n long, s array<long>, measured long")
    # Sums of components may pass 64 bits only beyond 2^37 vectors of the greatest magnitude.
    rows = found.groupBy("slot").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"),
        F.sum("measured").alias("measured")).collect()  # bounded: one row for each entry
    entries = books.entries.copy().reshape(parts * k, width)
    for r in rows:
        entries[r["slot"]] = [s // r["n"] for s in r["s"]]
    return Codebooks(entries.reshape(parts, k, width), books.pivots), sum(r["measured"] for r in rows)


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           pivots: int = PIVOTS, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, code, error, label_error,
    codebooks_sha256, measured_milli.

    Rows whose vector is null or holds a null or non-finite component are
    dropped. Codebooks begin with the parts of the ``entries`` smallest vec_ids
    (null last; rows of one vec_id by their components; fewer vectors give fewer entries). ``code`` has
    the entries' indexes in part order, two hex digits each; ``error`` is the sum of squared distances over
    the parts, ``label_error`` its sum over equal labels (nulls together).
    ``measured_milli`` is the share, in thousandths, of part-entry distances of the rounds that
    were measured exactly. Repeated rows are rows of their own. A vector shorter than the
    longest counts as zeros behind its end; a length that ``parts`` does not
    divide likewise. Components so great that squares leave 62 bits (2^27 for 64 dimensions) are
    taken as the greatest allowed. A missing label column is all null; other
    columns are not read. An empty table gives an empty result.
    """
    if entries > 256:
        raise ValueError("a code of two hex digits has at most 256 entries")
    if "label" not in vectors.columns:
        vectors = vectors.withColumn("label", F.lit(None).cast("int"))
    table, books = prepare(vectors, parts, scale, entries, pivots)
    if books is None:
        return table.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"),
            ("measured_milli", "long"))])
    measured = 0
    for _ in range(rounds):
        books, n = moved(table, books)
        measured += n
    rows = table.count()
    share = 1000 * measured // max(1, rows * rounds * books.entries.shape[0] * books.entries.shape[1])

    def codes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        entry_reach = books.reach()
        for x, reach in batches:
            found = [(c, d) for _, c, d, _ in _assigned(x, reach, books, entry_reach)]
            yield pd.DataFrame({
                "code": [bytes(c).hex() for block, _ in found for c in block.astype(np.uint8)],
                "error": np.concatenate([d.sum(axis=1) for _, d in found]) if found else np.zeros(0, np.int64)})

    udf = F.pandas_udf(codes, "code string, error long")
    coded = materialise(table.select("vec_id", "label", udf("x", "reach").alias("r")).select(
        "vec_id", "label", "r.code", "r.error"), "vector-codes")
    sums = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed(
        "label", "of_label"), "label-errors")
    if sums.count() <= BROADCAST_ROWS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"),
        F.lit(share).cast("long").alias("measured_milli"))
