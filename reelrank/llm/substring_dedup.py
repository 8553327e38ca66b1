"""Exact substring de-duplication over words, by fixed-block anchors.

A window is ``window`` consecutive words of one document. Of any two equal
windows the later one is a copy, and the words it covers are removed. Every
window holds at least one whole reference block: ``block = window // 2``
words at a position divisible by ``block``. So:

1. Index and probe. Rows are dealt into batches by doc_id, text and place, so
   that rows of one doc_id, equal ones too, lie in several. Each batch
   sends the hash of its rolling ``block``-word windows to the hash's bucket,
   once each, marked where one of them is a reference block or occurs twice
   in the batch. A bucket answers with one bit per hash: is it a hit, that is,
   a reference block that occurs somewhere else as well?
2. Extend. Windows without a hit are unique. For the others the batch sends
   the hash of the whole window, with the doc_id and tie-break of the earliest
   row that has it in the batch, and the bucket answers with one bit: is that the earliest copy of
   all? Neighbouring copies join to maximal repeats.

Only hashes and bits travel, as packed arrays of a batch and a bucket; a
hash that a third of all rows hold is sent once by each batch. Texts are
shuffled once: the three passes over them read the same exchange. Batches and
buckets are made as many as the input needs, so one of either stays near
``BATCH_BYTES`` of text. A bucket's number and 64 further bits make a window's
hash; as buckets grow with the input, so do the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
BATCH_BYTES = 4 << 20

_U = np.uint64
#: Order of rows of one doc_id: the first eight bytes of the text, then its hash.
_TIE = np.dtype([("head", "<u8"), ("h", "<i8")])
_BASE_A, _BASE_B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)  # odd


def _mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of each 64-bit value (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


class Batch:
    """Words of some documents as arrays, with hashes of their windows."""

    def __init__(self, doc_ids: np.ndarray, texts: list[bytes], none: np.ndarray, ties: np.ndarray):
        self.doc_ids, self.none, self.ties = doc_ids, none, ties
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = (self.data == 0x20) | ((self.data >= 9) & (self.data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.start, self.offsets)  # first word of each document

    def _words(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, _U)
        base = _BASE_A | _U(1)
        inverse = _U(pow(int(base), -1, 1 << 64))
        total = np.concatenate(([_U(0)], np.cumsum((self.data.astype(_U) + _U(1)) * _powers(base, len(self.data))[:-1],
                                                   dtype=_U)))
        value = (total[self.end] - total[self.start]) * _powers(inverse, len(self.data))[self.start]
        return _mix(value + (self.end - self.start).astype(_U) * _BASE_B)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word number, hash) of every window of ``n`` words within a document."""
        words = self._words()
        at = np.arange(max(0, len(words) - n + 1))
        at = at[self.doc[at] == self.doc[at + n - 1]] if len(at) else at
        value = np.zeros(len(at), _U)
        for i in range(n):
            value = value * _BASE_B + words[at + i]
        return at, _mix(value)


def _buckets(value: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each hash, from bits that the hash sent on does not repeat."""
    return ((_mix(value ^ _BASE_A) >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)


def _packets(batch: int, value: np.ndarray, n_buckets: int, columns: dict[str, np.ndarray]) -> Iterator[tuple]:
    """(bucket, batch, n, column bytes ...) of hashes sorted by bucket, then value."""
    bucket = _buckets(value, n_buckets)
    order = np.lexsort((value, bucket))
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    packed = [c[order] for c in columns.values()]
    for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(bucket)]))):
        if b > a:
            yield (int(bucket[a]), batch, int(b - a), *(p[a:b].tobytes() for p in packed))


def _spread_bits(value: np.ndarray, n_buckets: int, answers: pd.DataFrame) -> np.ndarray:
    """One boolean per hash in ``value`` (unique) from the buckets' answers."""
    bucket = _buckets(value, n_buckets)
    order = np.lexsort((value, bucket))
    rows = answers.sort_values("bucket")
    bits = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(rows["bits"], rows["n"])]
    out = np.zeros(len(value), bool)
    if bits:
        out[order] = np.concatenate(bits).astype(bool)
    return out


def _load(pdf: pd.DataFrame) -> Batch:
    """Documents of a batch, sorted by doc_id (null last), tie-break, then text."""
    texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
    ids, hashes = pdf["id"].to_numpy(np.int64), pdf["h"].to_numpy(np.int64)
    ties = np.empty(len(texts), _TIE)
    ties["head"] = [int.from_bytes(t[:8].ljust(8, b"\0"), "big") for t in texts]
    ties["h"] = hashes
    none = pdf["none"].to_numpy(bool)
    order = sorted(range(len(texts)), key=lambda i: (none[i], ids[i], ties["head"][i], hashes[i], texts[i]))
    return Batch(np.where(none, np.iinfo(np.int64).max, ids)[order], [texts[i] for i in order], none[order], ties[order])


def _anchors(batch: Batch, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unique block hashes, whether each is a reference block, whether it
    occurs twice; and for every rolling window (word number, hash index)."""
    at, value = batch.windows(block)
    unique, index, count = np.unique(value, return_inverse=True, return_counts=True)
    reference = np.zeros(len(unique), bool)
    reference[index[(at - batch.first[batch.doc[at]]) % block == 0]] = True
    return unique, reference, count > 1, np.stack((at, index))


def _candidates(batch: Batch, hit: np.ndarray, places: np.ndarray, window: int, block: int):
    """Windows that hold a hit: (word number, index of hash), unique hashes and
    the row (in document order) of the first window of each."""
    hot = np.zeros(len(batch.start) + 1, np.int64)
    hot[places[0][hit[places[1]]] + 1] = 1
    hot = np.cumsum(hot)
    at, value = batch.windows(window)
    keep = hot[at + window - block + 1] > hot[at]
    at, value = at[keep], value[keep]
    unique, first, index = np.unique(value, return_index=True, return_inverse=True)
    return at, index, unique, at[first]


def dedup_substrings(docs: DataFrame, window: int = WINDOW, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, n_removed, n_repeats, kept_text.

    Words are runs of bytes other than space and 0x09 to 0x0D. Earlier means
    smaller doc_id (null last), then, among rows of one doc_id, the smaller
    first eight bytes of the text, then the smaller hash of the text, then the
    earlier start; rows equal in both are copies of each other in some order. Null and empty texts have no words; documents shorter than a
    window lose nothing. ``n_repeats`` counts maximal removed runs. Rows are
    returned as often as given; other columns are not read.
    """
    if window < 2:  # a block is half a window
        raise ValueError("a window needs two words at least")
    block = window // 2
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = base.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    n = max(1, -(-int(size) // batch_bytes))
    # the place alone tells equal rows apart; their batch does not matter for the result
    rows = base.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    rows = rows.select(
        F.pmod(F.xxhash64("doc_id", "h", "place"), F.lit(n)).cast("int").alias("batch"), "doc_id",
        F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h", "text")

    def ask_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        unique, reference, twice, _ = _anchors(_load(pdf), block)
        short = (unique >> _U(32)).astype("<u4")  # with the bucket, enough to tell blocks apart
        flags = reference.astype(np.uint8) | twice.astype(np.uint8) << 1
        return pd.DataFrame(_packets(int(pdf["batch"].iat[0]), unique, n, {"h": short, "f": flags}),
                            columns=["bucket", "batch", "n", "hashes", "extra"])

    def answer_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        value = np.concatenate([np.frombuffer(b, "<u4") for b in pdf["hashes"]])
        flags = np.concatenate([np.frombuffer(b, np.uint8) for b in pdf["extra"]])
        _, index, count = np.unique(value, return_inverse=True, return_counts=True)
        hit = (np.bincount(index, flags & 1) > 0) & ((count > 1) | (np.bincount(index, flags >> 1) > 0))
        return _replies(pdf, hit[index])

    def ask_windows(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "batch", "n", "hashes", "extra", "ties"]
        if not len(pdf):
            return pd.DataFrame([], columns=columns)
        batch = _load(pdf)
        unique, _, _, places = _anchors(batch, block)
        hit = _spread_bits(unique, n, answers)
        _, _, value, first = _candidates(batch, hit, places, window, block)
        row = batch.doc[first]
        owner = batch.doc_ids[row].astype("<i8")
        small = len(owner) and owner.min() >= 0 and owner.max() < 1 << 32
        return pd.DataFrame(_packets(int(pdf["batch"].iat[0]), value, n,
                                     {"h": value.astype("<u8"), "d": owner.astype("<u4") if small else owner,
                                      "t": batch.ties[row]}), columns=columns)

    def answer_windows(pdf: pd.DataFrame) -> pd.DataFrame:
        value = np.concatenate([np.frombuffer(b, "<u8") for b in pdf["hashes"]])
        owner = np.concatenate([np.frombuffer(b, "<u4" if len(b) == 4 * k else "<i8").astype(np.int64)
                                for b, k in zip(pdf["extra"], pdf["n"])])
        sender = np.repeat(pdf["batch"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64))
        tie = np.concatenate([np.frombuffer(b, _TIE) for b in pdf["ties"]])
        order = np.lexsort((sender, tie["h"], tie["head"], owner, value))
        lead = np.concatenate(([True], value[order][1:] != value[order][:-1]))
        earliest = np.zeros(len(value), bool)
        earliest[order[lead]] = True
        return _replies(pdf, earliest)

    def cut(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_words", "n_removed", "n_repeats", "kept_text"]
        if not len(pdf):
            return pd.DataFrame([], columns=columns)
        batch = _load(pdf)
        unique, _, _, places = _anchors(batch, block)
        hit = _spread_bits(unique, n, answers[answers["step"] == 1])
        at, index, value, first = _candidates(batch, hit, places, window, block)
        earliest = _spread_bits(value, n, answers[answers["step"] == 2])
        copies = at[~(earliest[index] & (first[index] == at))]
        depth = np.zeros(len(batch.start) + 1, np.int64)
        np.add.at(depth, copies, 1)
        np.add.at(depth, copies + window, -1)
        return pd.DataFrame(_kept(batch, np.cumsum(depth)[:-1] > 0), columns=columns)

    packet = "bucket int, batch int, n int, hashes binary, extra binary"
    reply = "batch int, bucket int, n int, bits binary"
    texts = rows.groupBy("batch")
    hits = (texts.applyInPandas(ask_blocks, packet).groupBy("bucket").applyInPandas(answer_blocks, reply))
    firsts = (texts.cogroup(hits.groupBy("batch")).applyInPandas(ask_windows, packet + ", ties binary")
              .groupBy("bucket").applyInPandas(answer_windows, reply))
    answers = hits.withColumn("step", F.lit(1)).union(firsts.withColumn("step", F.lit(2)))
    return texts.cogroup(answers.groupBy("batch")).applyInPandas(
        cut, "doc_id long, n_words long, n_removed long, n_repeats long, kept_text string")


def _replies(pdf: pd.DataFrame, bits: np.ndarray) -> pd.DataFrame:
    """One bit per hash back to each batch, in the order it asked."""
    ends = np.cumsum(pdf["n"].to_numpy(np.int64))
    packed = [np.packbits(bits[e - k:e]).tobytes() for e, k in zip(ends, pdf["n"])]
    return pd.DataFrame({"batch": pdf["batch"], "bucket": pdf["bucket"], "n": pdf["n"], "bits": packed})


def _kept(batch: Batch, gone: np.ndarray) -> Iterator[tuple]:
    raw = batch.data.tobytes()
    for i, doc_id in enumerate(batch.doc_ids.tolist()):
        a, b = batch.first[i], batch.first[i + 1]
        mask = gone[a:b]
        keep = np.flatnonzero(~mask) + a
        kept = b" ".join([raw[s:e] for s, e in zip(batch.start[keep].tolist(), batch.end[keep].tolist())])
        runs = int(np.count_nonzero(np.diff(np.concatenate(([False], mask)).astype(np.int8)) == 1))
        yield (None if batch.none[i] else doc_id, int(b - a), int(mask.sum()), runs,
               kept.decode("utf-8", "surrogatepass"))
