"""SimHash near-duplicates, candidates found by pigeonring filtering.

A 64-bit fingerprint is cut into ``m = bits + 1`` consecutive segments on a
ring. If two fingerprints differ in at most ``bits`` places, then some
segment starts a chain in which the first segments together differ in at most
``l * bits / m`` places for every length l (the strong pigeonring principle).
For l = 1 that budget is below one: the first segment is equal. For l = 2 the
next segment differs in at most one place. The index therefore holds each
fingerprint under (segment, segment value, next segment value), and the probe
asks for its own value and every single-bit change of the next segment. The
longer chains are checked on the candidate pair, then the full distance.

Fingerprints are grouped before, so copies cost nothing. A key held by more
than ``hot`` fingerprints is not joined row by row: its members are cut into
blocks, every two blocks meet in a task of their own, and each task returns a
spanning forest of the links it found, never the pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import kept, materialise, unused, WORD_BYTES
from reelrank.llm.components import connected_components

SEED = 42
_WORDS = re.compile(WORD_BYTES)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text as a signed 64-bit integer (0 for a text without words)."""
    if not text:
        return 0
    words = _WORDS.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes.lower: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        bits = np.unpackbits(h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(ones * 2 > len(h)).view(">u8")[0]
    return int(value.astype(np.int64))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, h = hash of the text, fp long), one row per input row."""

    @F.pandas_udf("long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept("simhash")
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", F.xxhash64("text").alias("h"), udf("text").alias("fp"))


def _segments(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of each of the ``bits + 1`` segments, on a ring."""
    m = bits + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(m)]


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: Column, bits: int, probe: bool) -> Column:
    """Array of (seg, key) structs under which a fingerprint is held or sought."""
    out = []
    segs = _segments(bits)
    for i, (shift, width) in enumerate(segs):
        nshift, nwidth = segs[(i + 1) % len(segs)]
        first, nxt = _segment(fp, shift, width), _segment(fp, nshift, nwidth)
        changes = [0]
        if probe:  # a chain of two may differ in one place
            changes += [1 << k for k in range(nwidth)]
        for change in changes:
            key = F.shiftleft(first, 32).bitwiseOR(nxt.bitwiseXOR(F.lit(change)))
            out.append(F.struct(F.lit(i).alias("seg"), key.cast("long").alias("key")))
    return F.array(*out)


def _chain_ok(x: Column, y: Column, seg: Column, bits: int) -> Column:
    """Chains from segment ``seg`` keep within l * bits / m for every l."""
    segs, ok = _segments(bits), F.lit(False)
    m = len(segs)
    for i in range(m):
        inside, total = F.lit(True), F.lit(0)
        for step in range(m):
            shift, width = segs[(i + step) % m]
            total = total + F.bit_count(_segment(x.bitwiseXOR(y), shift, width))
            inside = inside & (total <= F.lit((step + 1) * bits // m))
        ok = ok | ((seg == i) & inside)
    return ok


def _forest(block_a: np.ndarray, block_b: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two blocks of fingerprints."""
    nodes = np.unique(np.concatenate([block_a, block_b]))
    where_b = np.searchsorted(nodes, block_b)
    parent = np.arange(len(nodes))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for a, na in zip(np.searchsorted(nodes, block_a), block_a):
        hit = where_b[np.bitwise_count(block_b.view(np.uint64) ^ np.uint64(np.int64(na).view(np.uint64))) <= bits]
        mine = root(a)
        # one link into each tree met: the rest are joined by it
        for other in hit[np.unique(parent[hit], return_index=True)[1]]:
            o = root(other)
            if o != mine:
                parent[max(o, mine)] = min(o, mine)
                edges.append((min(a, other), max(a, other)))
                mine = min(o, mine)
    return [(int(nodes[a]), int(nodes[b])) for a, b in edges]


def links(fps: DataFrame, bits: int = 4, hot: int = 64, block: int = 2048) -> DataFrame:
    """Distinct fingerprints (fp) -> (a, b) fingerprint pairs at ``bits`` or
    fewer differing places; for keys of more than ``hot`` fingerprints a
    spanning forest instead of all pairs. The components are exact."""
    if bits == 0:  # distinct fingerprints differ somewhere
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter(F.lit(False))
    held = fps.select("fp", F.explode(_keys(F.col("fp"), bits, False)).alias("k")).select("fp", "k.seg", "k.key")
    sought = fps.select("fp", F.explode(_keys(F.col("fp"), bits, True)).alias("k")).select("fp", "k.seg", "k.key")
    held = materialise(held, "simhash-held")
    heavy = materialise(held.groupBy("seg", "key").count().filter(F.col("count") > hot), "simhash-heavy")
    few = held.join(heavy, ["seg", "key"], "left_anti")
    x, y = F.col("x.fp"), F.col("y.fp")
    # Never a broadcast: Spark sizes sought as fps, without the keys that explode makes of each.
    cold = (sought.alias("x").join(few.alias("y").hint("merge"), ["seg", "key"])
            .filter((x != y) & _chain_ok(x, y, F.col("seg"), bits)
                    & (F.bit_count(x.bitwiseXOR(y)) <= bits))
            .select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")))

    if heavy.isEmpty():
        return cold
    # Both sides of a heavy key are dealt into blocks, each by its own count; block pairs meet by key.
    seekers = sought.join(heavy, ["seg", "key"], "left_semi").groupBy("seg", "key").agg(F.count("*").alias("seekers"))
    cut = materialise(heavy.join(seekers, ["seg", "key"]).select(
        "seg", "key", F.ceil(F.col("count") / block).cast("int").alias("nh"),
        F.ceil(F.col("seekers") / block).cast("int").alias("ns")), "simhash-cut")
    held_hot = (held.join(cut, ["seg", "key"])
                .withColumn("hb", F.pmod(F.xxhash64("fp"), F.col("nh")).cast("int")))
    sought_hot = (sought.join(cut, ["seg", "key"])
                  .withColumn("sb", F.pmod(F.xxhash64("fp"), F.col("ns")).cast("int")))
    left = held_hot.withColumn("sb", F.explode(F.sequence(F.lit(0), F.col("ns") - 1))).withColumn("side", F.lit(0))
    right = sought_hot.withColumn("hb", F.explode(F.sequence(F.lit(0), F.col("nh") - 1))).withColumn("side", F.lit(1))
    cols = ["seg", "key", "hb", "sb", "side", "fp"]

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["fp"].to_numpy(np.int64)
        side = pdf["side"].to_numpy()
        found = _forest(np.unique(v[side == 1]), np.unique(v[side == 0]), bits)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    warm = (left.select(cols).union(right.select(cols))
            .groupBy("seg", "key", "hb", "sb").applyInPandas(meet, "a long, b long"))
    return cold.union(warm)


def _grouped(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """doc_id, h (hash of the text), fp, component (a fingerprint of the
    group), component_id, n_fingerprint_rows of every row."""
    fp = docs.select(F.col("doc_id").cast("long"), "text")
    fp = materialise(fingerprints(fp, shingle), "simhash-fp")
    classes = materialise(
        fp.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_fingerprint_rows")),
        "simhash-classes")
    parts = connected_components(links(classes.select("fp"), bits))
    member = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    member = member.withColumn("component", F.coalesce("component", "fp"))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "component").select("fp", "component", "component_id", "n_fingerprint_rows")
    return fp.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """SimHash groups of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex
    digits), component_id (smallest doc_id reachable by links of at most
    ``bits`` differing places, itself included), n_fingerprint_rows.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other. Repeated rows and repeated doc_ids are returned as often as given;
    a null doc_id is returned and its row still links other rows, but it never
    names a component unless all members are null. An empty table gives no rows.
    """
    return _grouped(docs, shingle, bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id", "n_fingerprint_rows")


def keep_one(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each SimHash group, all columns kept: the one with
    the smallest doc_id (null last), then the smallest hash of its text. Of
    rows equal in both one stays."""
    groups = materialise(_grouped(docs, shingle, bits).select("doc_id", "h", "component"), "simhash-groups")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    id_, h = unused(docs.columns, "id", "h")
    heads = materialise(groups.groupBy("component").agg(F.min(place).alias("p")).select(
        F.col("p.doc_id").alias(id_), F.col("p.h").alias(h)), "simhash-heads")
    rows = docs.withColumn(h, F.xxhash64("text"))
    kept = rows.alias("d").join(
        heads.alias("k"), (rows[h] == heads[h]) & rows["doc_id"].cast("long").eqNullSafe(heads[id_]), "left_semi")
    # texts are dealt out once more only where some row is repeated
    repeated = not groups.groupBy("doc_id", "h").count().filter("count > 1").isEmpty()
    return (kept.dropDuplicates(["doc_id", h]) if repeated else kept).select(docs.columns)
