"""Near-duplicate vectors with one HNSW graph per shard.

Vectors are grouped by label, equal vectors are folded into one with a
multiplicity, and each label is cut into shards of about ``shard_rows`` vectors.
A graph is built for each shard; then every shard queries every shard of its
label (each unordered pair of shards once, links are symmetric). Before a pair
is answered, an audit compares the beam search of some of the queries with brute
force, and the beam is widened until the recall passes; a beam as wide as the
shard is brute force. Hits are verified by cosine in double precision.

A task returns the number of links of each vector and a spanning forest of
the links it found, never the pairs, so a group of many near copies stays
linear in what it sends.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise
from reelrank.llm.components import connected_components

THRESHOLD = 0.98
SHARD_ROWS = 4096
#: Neighbours kept per node, beam while building, first beam while searching.
LINKS, BUILD_BEAM, BEAM = 16, 48, 32
AUDIT, RECALL = 64, 0.995
#: A beam of this share of a shard costs more than comparing with all of it, which is done instead.
BRUTE_SHARE = 8
#: Room left for rounding before a pair is compared in double precision.
_SLACK = 1e-5
_BLOCK = 512


class Graph:
    """A navigable small-world hierarchy over unit vectors (float32 rows).

    Level of a node: how often a hash coin came up, so that each level holds
    about one in ``LINKS`` nodes of the level below. Nodes are added in
    batches of growing size: a batch is searched in the graph of the
    nodes before it, all queries of the batch in step.
    """

    def __init__(self, unit: np.ndarray, seed: int = 0):
        self.unit = np.ascontiguousarray(unit, np.float32)
        n = len(unit)
        coin = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(np.maximum(coin, 1e-12)) / np.log(LINKS)).astype(int), 6)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (members, neighbours by member or -1)
        for top in range(int(level.max(initial=0)), -1, -1):
            members = np.flatnonzero(level >= top)
            self.levels.append((members, self._build(members, 2 * LINKS if top == 0 else LINKS)))

    def _build(self, members: np.ndarray, width: int) -> np.ndarray:
        """Neighbour table of one level; rows are positions in ``members``."""
        unit, n = self.unit[members], len(members)
        table = np.full((n, width), -1, np.int32)
        done = min(n, max(64, 2 * width))
        near = unit[:done] @ unit[:done].T
        np.fill_diagonal(near, -2)
        if done > 1:
            k = min(width // 2, done - 1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :k]
            self._connect(unit, table, np.arange(done), order)
        while done < n:
            batch = np.arange(done, min(n, done + max(32, done // 2), done + _BLOCK))
            found, sims = _beam(unit, table, unit[batch], np.zeros((len(batch), 1), np.int64), BUILD_BEAM)
            own = unit[batch] @ unit[batch].T  # members of the batch see each other too
            np.fill_diagonal(own, -2)
            both = np.concatenate([found, np.broadcast_to(batch, own.shape)], axis=1)
            value = np.concatenate([sims, own], axis=1)
            order = np.argsort(-value, axis=1, kind="stable")[:, :LINKS]
            chosen = np.take_along_axis(both, order, 1)
            chosen[np.take_along_axis(value, order, 1) <= -2] = -1
            self._connect(unit, table, batch, chosen)
            done = int(batch[-1]) + 1
        return table

    @staticmethod
    def _connect(unit: np.ndarray, table: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
        """Add edges node -> chosen and back; a full row keeps its nearest half
        and, for the rest, the neighbours least alike to those."""
        width = table.shape[1]
        a = np.repeat(nodes, chosen.shape[1])
        b = chosen.ravel()
        a, b = np.concatenate([a[b >= 0], b[b >= 0]]), np.concatenate([b[b >= 0], a[b >= 0]])
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        cuts = np.flatnonzero(np.diff(a)) + 1
        for node, add in zip(a[np.concatenate(([0], cuts))] if len(a) else [], np.split(b, cuts)):
            row = table[node]
            all_ = np.unique(np.concatenate([row[row >= 0], add]))
            all_ = all_[all_ != node]
            if len(all_) > width:
                sims = unit[all_] @ unit[node]
                all_ = all_[np.argsort(-sims, kind="stable")]
                half = width // 2
                keep, rest = all_[:half], all_[half:]
                spread = np.argsort((unit[rest] @ unit[keep].T).max(1), kind="stable")[:width - half]
                all_ = np.concatenate([keep, rest[spread]])
            table[node] = -1
            table[node, :len(all_)] = all_

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(node, similarity) of the ``beam`` nearest found, by similarity; -1 pads."""
        start = None
        for i, (members, table) in enumerate(self.levels):
            last = i == len(self.levels) - 1
            entry = np.zeros((len(queries), 1), np.int64) if start is None else start
            found, sims = _beam(self.unit[members], table, queries, entry, beam if last else 4)
            if last:
                return np.where(found >= 0, members[found], -1), sims
            below = self.levels[i + 1][0]
            start = np.searchsorted(below, members[np.maximum(found[:, :2], 0)])
        raise AssertionError("a graph has a level")


def _beam(unit: np.ndarray, table: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int):
    """Beam search of all queries in step: each round every query expands its
    best open node, until none of its beam is open."""
    q, n = len(queries), len(unit)
    rows = np.arange(q)
    seen = np.zeros((q, n), bool)
    nodes = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -3.0, np.float32)
    open_ = np.zeros((q, beam), bool)
    k = min(entry.shape[1], beam)
    for j in range(k):  # entries may repeat
        fresh = ~seen[rows, entry[:, j]]
        seen[rows, entry[:, j]] = True
        value = np.einsum("ij,ij->i", unit[entry[:, j]], queries)
        nodes[fresh, j], sims[fresh, j], open_[fresh, j] = entry[fresh, j], value[fresh], True
    active = rows
    while len(active):
        best = np.where(open_[active], sims[active], -4.0).argmax(1)
        alive = open_[active, best]
        active, best = active[alive], best[alive]
        if not len(active):
            break
        at = nodes[active, best]
        open_[active, best] = False
        near = table[at].astype(np.int64)
        valid = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        seen[np.repeat(active, near.shape[1])[valid.ravel()], near.ravel()[valid.ravel()]] = True
        value = np.einsum("ijk,ik->ij", unit[np.maximum(near, 0)], queries[active])
        value = np.where(valid, value, -3.0).astype(np.float32)
        all_nodes = np.concatenate([nodes[active], np.where(valid, near, -1)], axis=1)
        all_sims = np.concatenate([sims[active], value], axis=1)
        all_open = np.concatenate([open_[active], valid], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        nodes[active] = np.take_along_axis(all_nodes, top, 1)
        sims[active] = np.take_along_axis(all_sims, top, 1)
        open_[active] = np.take_along_axis(all_open, top, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _links(graph: Graph, target: np.ndarray, queries: np.ndarray, threshold: float, beam: int) -> list[np.ndarray]:
    """For each query the targets at ``threshold`` or more, verified in double
    precision. While a whole beam is above the threshold the beam is widened."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    open_, n = np.arange(len(queries)), len(target)
    while len(open_):
        again = []
        for at in range(0, len(open_), _BLOCK):
            rows = open_[at:at + _BLOCK]
            if beam * BRUTE_SHARE >= n:
                found = np.broadcast_to(np.arange(n), (len(rows), n))
                likely = (queries[rows] @ target.T) >= threshold - _SLACK
            else:
                found, sims = graph.search(queries[rows].astype(np.float32), beam)
                likely = (sims >= threshold - _SLACK) & (found >= 0)
                full = likely.all(1)
                again.append(rows[full])
                likely[full] = False
            i, j = np.nonzero(likely)
            exact = np.einsum("ij,ij->i", queries[rows[i]], target[found[i, j]])
            keep = exact >= threshold
            i, hit = i[keep], found[i[keep], j[keep]]
            for a, part in zip(*_groups(i, hit)):
                out[rows[a]] = part
        open_ = np.concatenate(again) if again else np.zeros(0, np.int64)
        beam *= 4
    return out


def _groups(keys: np.ndarray, values: np.ndarray):
    if not len(keys):
        return [], []
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate(([0], cuts))], np.split(values, cuts)


def audited_links(graph: Graph, target: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[list, int, float]:
    """Links of every query, the beam that passed the audit, its audited recall."""
    pick = np.unique(np.linspace(0, len(queries) - 1, min(AUDIT, len(queries))).astype(int))
    truth = _links(graph, target, queries[pick], threshold, len(target))
    total, beam = sum(map(len, truth)), BEAM
    while True:
        found = _links(graph, target, queries[pick], threshold, beam)
        recall = sum(map(len, found)) / total if total else 1.0
        if recall >= RECALL or beam * BRUTE_SHARE >= len(target):
            return _links(graph, target, queries, threshold, beam), beam, recall
        beam *= 2


def _forest(a: list[int], groups: list[np.ndarray], b: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for x, part in zip(a, groups):
        for y in b[part].tolist():
            r, s = root(x), root(y)
            if r != s:
                parent[max(r, s)] = min(r, s)
                edges.append((x, y))
    return edges


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, n_links, component_id, kept.

    Links join vectors of one label and one length whose cosine is at least
    ``threshold``. Null labels, vectors that are null, empty or zero, and vectors with null
    or non-finite components link with nothing and are their own component. Equal vectors always
    link. Rows are returned as often as given, repeated rows count as vectors of
    their own; a null vec_id links, but names a component only if all its members are null
    (such a row is kept). Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                          F.col("embedding").cast("array<double>").alias("v"))
    fit = F.col("label").isNotNull() & _usable("v")
    rows = rows.select("vec_id", F.when(fit, F.struct(F.col("label"), F.size("v").alias("dim"))).alias("part"),
                       F.when(fit, F.col("v")).alias("v"),
                       F.when(fit, F.xxhash64("label", "v")).alias("x"), F.when(fit, F.xxhash64("v", "label")).alias("y"))
    rows = materialise(rows, "vectors")
    good = rows.filter("part is not null")
    # Equal vectors (128-bit hash) fold into one node; its id is a hash of the vector.
    nodes = good.groupBy("part", "x", "y").agg(F.first("v").alias("v"), F.count("*").alias("copies"),
                                               F.min("vec_id").alias("low"))
    sizes = nodes.groupBy("part").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    nodes = nodes.join(sizes, "part").withColumn("shard", F.pmod(F.xxhash64("y", "x"), F.col("shards")).cast("int"))
    nodes = materialise(nodes, "vector-nodes")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["x", "y"])
        unit = _unit(np.stack(pdf["v"].to_numpy()))
        pack = (unit, pdf["x"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), Graph(unit))
        return pd.DataFrame({"shard": [int(pdf["shard"].iat[0])], "shards": [int(pdf["shards"].iat[0])],
                             "pack": [pickle.dumps(pack, protocol=5)]})

    keyed = nodes.withColumn("pk", F.xxhash64("part"))
    graphs = materialise(keyed.groupBy("pk", "shard").applyInPandas(
        lambda key, pdf: build(pdf).assign(pk=key[0])[["pk", "shard", "shards", "pack"]],
        "pk long, shard int, shards int, pack binary"), "vector-graphs")
    pairs = graphs.select("pk", F.col("shard").alias("a"), F.explode(F.sequence("shard", F.col("shards") - 1)).alias("b"))
    left = graphs.select("pk", F.col("shard").alias("a"), F.col("pack").alias("pa"))
    right = graphs.select("pk", F.col("shard").alias("b"), F.col("pack").alias("pb"))
    met = pairs.join(left, ["pk", "a"]).join(right, ["pk", "b"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, b, pa, pb in zip(pdf["a"], pdf["b"], pdf["pa"], pdf["pb"]):
            unit_a, id_a, copies_a, _ = pickle.loads(pa)
            unit_b, id_b, copies_b, graph = pickle.loads(pb)
            found, beam, recall = audited_links(graph, unit_b, unit_a, threshold)
            if a == b:  # no node links with itself; copies of a node are counted below
                found = [f[f != i] for i, f in enumerate(found)]
            mine = np.array([copies_b[f].sum() for f in found], np.int64)
            edges = _forest(id_a.tolist(), found, id_b, {})
            out.append(pd.DataFrame({"node": id_a, "links": mine, "other": np.int64(0)}))
            if a != b:
                theirs = np.zeros(len(id_b), np.int64)
                for c, f in zip(copies_a.tolist(), found):
                    theirs[f] += c
                out.append(pd.DataFrame({"node": id_b, "links": theirs, "other": np.int64(0)}))
            if edges:
                out.append(pd.DataFrame(edges, columns=["node", "other"], dtype="int64").assign(links=np.int64(-1)))
        return pd.concat(out)[["node", "links", "other"]]

    links = materialise(met.groupBy("pk", "a", "b").applyInPandas(meet, "node long, links long, other long"), "vector-links")
    counts = links.filter("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(links.filter("links = -1").select(F.col("node").alias("a"), F.col("other").alias("b")))
    member = (nodes.select(F.col("x").alias("node"), "low", "copies").join(parts, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "component").join(counts, "node", "left").select(
        F.col("node").alias("x"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = rows.join(named, "x", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
