"""A multi-output regression forest over low-cardinality features (M7).

One ordered feature (binned), some categorical ones, any number of targets. A
user's row matters to a tree only through its cell (bin x levels), so the data
is read once: one grouped aggregate gives, for every tree and cell, the
bootstrap weights and the weighted sums of all targets. Each tree is then grown
in a task of its own from these sums. Its cost depends on the cells (bins x
levels, bounded by ``max_bins`` and the vocabularies), not on the number of rows.

A split is the one that lowers the squared error summed over the targets most:
the ordered feature at a border of two bins, or one level against the rest.
Bootstrap weights are Poisson(1) draws from a hash of the row's key and the
tree, so they depend on neither partitioning nor order.

The grown forest is also compiled: its mean prediction for every cell, levels
unseen in training included, is one small table, and predicting is a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.session import cut_lineage

#: Cumulative Poisson(1) probabilities: a draw counts how many are not above it.
_CUMULATIVE = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12)]
#: Gains closer than this, relatively, count as equal.
_ROUNDING = 1e-9
_NODE = ("tree int, node int, feature int, at int, left int, right int, n_rows long, value array<double>")


def borders(df: DataFrame, column: str, max_bins: int) -> list[float]:
    """Ascending borders between the bins of a numeric column: midpoints of its
    values, or approximate quantiles where there are more than ``max_bins``."""
    known = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    few = [r["v"] for r in known.distinct().orderBy("v").limit(max_bins + 1).collect()]  # bounded by max_bins
    if len(few) <= max_bins:
        return [(a + b) / 2 for a, b in zip(few, few[1:])]
    return sorted(set(known.approxQuantile("v", [i / max_bins for i in range(1, max_bins)], 0.001)))


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """How many borders are below the value; a null counts as the lowest bin."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.lit(list(cuts)), lambda c: c < value.cast("double")))
    return F.when(value.isNull(), 0).otherwise(below).cast("int")


def level_of(value: Column, levels: Sequence[str]) -> Column:
    """The level's number; the number of levels for null and unseen values."""
    if not levels:
        return F.lit(0)
    place = F.array_position(F.lit(list(levels)), value)
    return F.when(place > 0, place - 1).otherwise(len(levels)).cast("int")


def cell_sums(rows: DataFrame, key: str, features: Sequence[str], targets: Sequence[str],
              trees: int, seed: int) -> DataFrame:
    """tree, features, n_rows (distinct rows drawn), w (weights by target, null
    targets left out), s (weighted sums): one row for each tree and cell that it drew."""
    draws = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "_u", F.xxhash64(F.lit(seed), "tree", key).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53))
    weight = " + ".join(f"int(_u >= {c!r}D)" for c in _CUMULATIVE)
    drawn = draws.withColumn("_w", F.expr(weight).cast("double")).filter("_w > 0")
    sums = drawn.groupBy("tree", *features).agg(
        F.count("*").alias("n_rows"),
        F.array(*[F.expr(f"sum(CASE WHEN `{t}` IS NOT NULL THEN _w ELSE 0D END)") for t in targets]).alias("w"),
        F.array(*[F.expr(f"coalesce(sum(_w * `{t}`), 0D)") for t in targets]).alias("s"))
    return sums


def _gain(w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Sum over the targets of sum^2 / weight: what a part explains."""
    return np.divide(s * s, w, out=np.zeros_like(s), where=w > 0).sum(axis=-1)


def _first_best(gain: np.ndarray) -> int:
    """The first of the gains that differ from the greatest by rounding only."""
    top = float(gain.max())
    return int(np.argmax(gain >= top - _ROUNDING * max(1.0, abs(top))))


def _best_split(cells: np.ndarray, n: np.ndarray, w: np.ndarray, s: np.ndarray,
                levels: Sequence[int]) -> tuple[float, int, int] | None:
    """(gain, feature, at) of the best split of a node's cells, the first among
    equals: feature 0 sends bins up to ``at`` left, feature k sends level ``at`` right."""
    all_w, all_s = w.sum(axis=0), s.sum(axis=0)
    best: tuple[float, int, int] | None = None
    order = np.argsort(cells[:, 0], kind="stable")
    bins = cells[order, 0]
    edge = np.flatnonzero(bins[1:] != bins[:-1])
    if len(edge):
        left_w, left_s = np.cumsum(w[order], axis=0)[edge], np.cumsum(s[order], axis=0)[edge]
        gain = _gain(left_w, left_s) + _gain(all_w - left_w, all_s - left_s)
        at = _first_best(gain)
        best = float(gain[at]), 0, int(bins[edge[at]])
    for k, size in enumerate(levels, 1):
        one = cells[:, k][None, :] == np.arange(size)[:, None]
        held = one @ n
        some = np.flatnonzero((held > 0) & (held < n.sum()))
        if not len(some):
            continue
        one = one[some].astype(float)
        part_w, part_s = one @ w, one @ s
        gain = _gain(part_w, part_s) + _gain(all_w - part_w, all_s - part_s)
        at = _first_best(gain)
        if best is None or gain[at] > best[0] + _ROUNDING * max(1.0, abs(best[0])):
            best = float(gain[at]), k, int(some[at])
    return best


def grow(cells: np.ndarray, n: np.ndarray, w: np.ndarray, s: np.ndarray, levels: Sequence[int],
         max_depth: int, min_split: int) -> list[tuple]:
    """Nodes (node, feature, at, left, right, n_rows, value) of one tree, the
    root first; a leaf has feature -1. ``levels``: known levels of each
    categorical feature. A target without weight in a node keeps its parent's value."""
    out: list[tuple] = [()]
    root = np.arange(len(cells))
    todo = [(0, root, 0, np.zeros(w.shape[1]))]
    while todo:
        node, mine, depth, above = todo.pop()
        total_w, total_s = w[mine].sum(axis=0), s[mine].sum(axis=0)
        value = np.where(total_w > 0, np.divide(total_s, total_w, out=np.zeros_like(total_s), where=total_w > 0), above)
        rows = int(n[mine].sum())
        split = None
        if rows >= min_split and depth < max_depth and len(mine) > 1:
            split = _best_split(cells[mine], n[mine], w[mine], s[mine], levels)
            base = float(_gain(total_w, total_s))
            if split is not None and split[0] <= base + _ROUNDING * max(1.0, abs(base)):
                split = None
        if split is None:
            out[node] = (node, -1, -1, -1, -1, rows, value.tolist())
            continue
        _, feature, at = split
        right = cells[mine, feature] > at if feature == 0 else cells[mine, feature] == at
        out[node] = (node, feature, at, len(out), len(out) + 1, rows, value.tolist())
        out += [(), ()]
        todo.append((len(out) - 1, mine[right], depth + 1, value))
        todo.append((len(out) - 2, mine[~right], depth + 1, value))
    return out


def grow_trees(sums: DataFrame, features: Sequence[str], levels: Sequence[int], max_depth: int, min_split: int) -> DataFrame:
    """Every tree grown in its own task from its cells: one row for each node."""
    names, counts = list(features), list(levels)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        # cells in one order whatever order they came in
        pdf = pdf.sort_values(names)
        nodes = grow(pdf[names].to_numpy(np.int64), pdf["n_rows"].to_numpy(np.int64), np.stack(pdf["w"].to_numpy()),
                     np.stack(pdf["s"].to_numpy()), counts, max_depth, min_split)
        found = pd.DataFrame(nodes, columns=["node", "feature", "at", "left", "right", "n_rows", "value"])
        found.insert(0, "tree", pdf["tree"].iloc[0])
        return found

    return sums.groupBy("tree").applyInPandas(one, _NODE)


def _walk(nodes: pd.DataFrame, cells: np.ndarray) -> np.ndarray:
    """The leaf of each cell in one tree."""
    nodes = nodes.sort_values("node")
    feature, at, left, right = (nodes[c].to_numpy() for c in ("feature", "at", "left", "right"))
    place = np.zeros(len(cells), np.int64)
    while True:
        inner = np.flatnonzero(feature[place] >= 0)
        if not len(inner):
            return place
        f, a = feature[place[inner]], at[place[inner]]
        x = cells[inner, f]
        place[inner] = np.where(np.where(f == 0, x > a, x == a), right[place[inner]], left[place[inner]])


def compiled(nodes: DataFrame, features: Sequence[str], sizes: Sequence[int], outputs: Sequence[str]) -> DataFrame:
    """Mean prediction over the trees for every cell; ``sizes``: values of each
    feature, the unseen level included. Sums are exact, so their order does not matter."""
    names = list(features)
    grid = np.array(np.meshgrid(*[np.arange(n) for n in sizes], indexing="ij")).reshape(len(sizes), -1).T
    schema = ", ".join(f"{f} int" for f in names) + ", value array<double>"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        leaves = _walk(pdf, grid)
        found = pd.DataFrame(grid, columns=names)
        found["value"] = pdf.sort_values("node")["value"].to_numpy()[leaves]
        return found

    each = nodes.groupBy("tree").applyInPandas(one, schema)
    return each.groupBy(*names).agg(*[
        (F.sum(F.col("value")[i].cast("decimal(38,18)")).cast("double") / F.count("*")).alias(name)
        for i, name in enumerate(outputs)])


def fit(rows: DataFrame, key: str, features: Sequence[str], levels: Sequence[int], targets: Sequence[str],
        trees: int, max_depth: int, min_split: int, seed: int) -> DataFrame:
    """The nodes of all trees, written once. ``rows``: ``key``, the features as
    numbers (the ordered one first), the targets."""
    sums = cell_sums(rows, key, features, targets, trees, seed)
    return cut_lineage(grow_trees(sums, features, levels, max_depth, min_split))
