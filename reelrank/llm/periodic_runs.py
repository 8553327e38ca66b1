"""Periodic runs of words, found by an online sparse diagonal DP.

A diagonal is a lag d: its match length at word i counts how many words in a
row equal the word d places before them. A run of period d is a stretch whose
diagonal reached at least ``max(min_length - d, d)`` matches before it ended.

Reading a document from left to right, each step looks up the earlier
occurrences of what it reads; each of them increments the match length of its
lag, and a lag that is not among them ends and emits its stretch at once if it
is long enough. Two things keep this sparse without dropping a case:

* Lags are taken in ranges [c, 2c) of their own, and a step reads not a word but
  an aligned block of about c/2 words: a stretch of c matches always holds such
  a block, and only 2n pairs (block, lag) of a range exist, however often a
  word occurs. Blocks without an earlier occurrence cost no step.
* The exact ends of a stretch lie less than a block away and are found by
  bisection on prefix fingerprints.

So a document of n words costs O(n log^2 n), also if it is one word repeated.
A stretch is met on every multiple of its smallest period; the smallest one
names it. Words are compared by id; blocks by polynomial fingerprints modulo
two primes of 31 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: Bytes of a text that are split into words at a time, and cells (block, lag)
#: that are compared at a time: bounds of memory, not of what is read.
CHUNK_BYTES, CELLS = 1 << 20, 1 << 18

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PRIMES, _BASES = (2147483647, 2147483629), (1103515245, 1664525021)
_ODD_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.int64), np.ones(1, np.int64)]


def word_ids(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Ids of the words in order (0 for the first new word, 1 ...) and the words by id."""
    ids, number, at = [], {}, 0
    while at < len(data):
        end = _SPACE.search(data, min(at + CHUNK_BYTES, len(data)))
        end = end.start() if end else len(data)
        words = data[at:end].split()  # bytes.split parts at exactly these six bytes
        ids.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        at = end + 1
    return np.concatenate(ids) if ids else np.array([], np.int64), list(number)


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n of the three bases, kept and doubled on demand."""
    while len(_POWERS[0]) <= n:
        wrap, *rest = _POWERS
        _POWERS[0] = np.concatenate([wrap, wrap * (wrap[-1:] * np.uint64(_ODD_BASE))])
        for k, (p, b) in enumerate(zip(_PRIMES, _BASES)):
            _POWERS[k + 1] = np.concatenate([rest[k], rest[k] * (rest[k][-1] * b % p) % p])
    return _POWERS


class _Prefixes:
    """Fingerprints of any stretch of a word sequence."""

    def __init__(self, ids: np.ndarray):
        self.n = n = len(ids)
        self.powers = _powers(n)
        x = ids + 1
        with np.errstate(over="ignore"):
            self.wrap = np.concatenate([[np.uint64(0)], np.cumsum(x.astype(np.uint64) * self.powers[0][:n])])
        self.sums = [np.concatenate([[0], np.cumsum(x * w[:n] % p) % p]) for p, w in zip(_PRIMES, self.powers[1:])]

    def same(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Whether ``size`` words from ``at`` equal those ``lag`` places before."""
        equal = np.ones(len(at), bool)
        for p, s, w in zip(_PRIMES, self.sums, self.powers[1:]):
            here, there = (s[at + size] - s[at]) % p, (s[at - lag + size] - s[at - lag]) % p
            equal &= there * w[lag] % p == here
        return equal

    def stretches(self, size: int) -> np.ndarray:
        """A first fingerprint (modulo 2^64) of the ``size`` words from each place."""
        return self.wrap[size:] - self.wrap[:self.n - size + 1]

    def repeats(self, whole: np.ndarray, first: int, last: int, size: int, lags: np.ndarray) -> np.ndarray:
        """Blocks number ``first`` to ``last`` - 1 of ``size`` words x lags: equal to
        the words a lag before; ``whole``: see :meth:`stretches`."""
        at = np.arange(first, last) * size
        before = at[:, None] - lags[None, :]
        hit = whole[np.maximum(before, 0)] * self.powers[0][lags][None, :] == whole[at][:, None]
        hit &= before >= 0
        rows, cols = hit.nonzero()
        if len(rows):
            hit[rows, cols] = self.same(at[rows], lags[cols], size)
        return hit


def _chains(prefixes: _Prefixes, size: int, lags: np.ndarray) -> list[np.ndarray]:
    """The DP over blocks: (lag, first word, last word + 1) of every chain of blocks
    in a row that occurred ``lag`` words before, emitted when it ends."""
    blocks, out = prefixes.n // size, []
    length = np.zeros(len(lags), np.int64)  # match length of each active lag, in blocks
    at = -1                                 # the block read last

    def emit(ended: np.ndarray) -> None:
        if len(ended):
            out.append(np.stack([lags[ended], (at + 1 - length[ended]) * size,
                                 np.full(len(ended), (at + 1) * size)]))
            length[ended] = 0

    batch, whole = max(1, CELLS // len(lags)), prefixes.stretches(size)
    for first in range(0, blocks, batch):
        hits = prefixes.repeats(whole, first, min(first + batch, blocks), size, lags)
        for row in hits.any(axis=1).nonzero()[0]:
            block = first + int(row)
            emit((length > 0).nonzero()[0] if block != at + 1 else ((length > 0) & ~hits[row]).nonzero()[0])
            length += hits[row]
            at = block
    emit((length > 0).nonzero()[0])
    return out


def _stretched(prefixes: _Prefixes, chains: np.ndarray, size: int, min_length: int) -> np.ndarray:
    """(start, length, period) of the chains that are long enough once both
    ends, each less than a block away, are found."""
    need = np.maximum(min_length - chains[0], chains[0])
    lag, first, end = chains[:, chains[2] - chains[1] + 2 * (size - 1) >= need]
    right, left = np.zeros(len(lag), np.int64), np.zeros(len(lag), np.int64)
    step = 1 << (size - 1).bit_length()
    while step := step >> 1:
        fits = (end + right + step <= prefixes.n).nonzero()[0]
        ok = fits[prefixes.same(end[fits] + right[fits], lag[fits], step)]
        right[ok] += step
        fits = (first - left - step - lag >= 0).nonzero()[0]
        ok = fits[prefixes.same(first[fits] - left[fits] - step, lag[fits], step)]
        left[ok] += step
    first, end = first - left, end + right
    enough = end - first >= np.maximum(min_length - lag, lag)
    return np.stack([first - lag, end - first + lag, lag])[:, enough]


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) columns of every run, by start, then period.

    A run is a stretch with smallest period q and at least ``max(min_length,
    2 * q)`` words that no neighbouring word extends keeping period q.
    """
    n, found = len(ids), []
    low, high = 1, max(min_length, 2)
    if n < min_length:
        return np.zeros((3, 0), np.int64)
    prefixes = _Prefixes(ids)
    while 2 * low <= n:
        lags = np.arange(low, min(high, n // 2 + 1))
        # the least number of matches that a run of such a lag has holds an aligned block
        size = (int(np.maximum(min_length - lags, lags).min()) + 1) // 2
        chains = _chains(prefixes, size, lags)
        if chains:
            found.append(_stretched(prefixes, np.concatenate(chains, axis=1), size, min_length))
        low, high = high, 2 * high
    if not found:
        return np.zeros((3, 0), np.int64)
    runs = np.concatenate(found, axis=1)
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    new = np.ones(runs.shape[1], bool)  # not a multiple of the period before it
    new[1:] = (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] != runs[1, :-1])
    runs = runs[:, new]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def collapsed(ids: np.ndarray, words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without what a run holds after its first period."""
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, runs[0] + runs[2], 1)
    np.add.at(edge, runs[0] + runs[1], -1)
    kept = ids[np.cumsum(edge[:-1]) == 0]
    return b" ".join([words[i] for i in kept.tolist()])


def detect(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, runs array<struct<start, length,
    period>> by start, then period, collapsed (the text without repetitions).

    Words are what white space (0x20, 0x09 to 0x0D) parts. Null and empty texts
    have no words, no runs and an empty collapsed text. Each row is judged by
    itself: rows come back as often as given, whatever their ids; other columns
    are not read.
    """
    @F.pandas_udf("n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                data = b"" if text is None else text.encode("utf-8", "surrogatepass")
                ids, words = word_ids(data)
                runs = find_runs(ids, min_length)
                spans = [dict(start=s, length=n, period=q) for s, n, q in runs.T.tolist()]
                rows.append((len(ids), spans, collapsed(ids, words, runs).decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return docs.select("doc_id", udf("text").alias("_r")).select("doc_id", "_r.*")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, text: where h = crc32(decimal doc_id) is a
    multiple of ten, the words from number a on repeat with period p, where g =
    h // 10, a = g mod n, p = 1 + (n - a) // (3 + g mod 8), n words. Other texts,
    also those without words or doc_id, stay as they are."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    planted = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")).select(
        "doc_id", "text", F.expr("h div 10").alias("g"),
        F.when(F.col("h") % 10 == 0, words).alias("w")).withColumn("n", F.size("w")).select(
        "doc_id", "text", "w", "g", "n", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    # the array is indexed as a whole: no word is looked up by its text
    repeated = F.expr("transform(sequence(0, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)])")
    return planted.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", repeated)).otherwise(
        F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """What :func:`detect` found -> doc_id, n_runs, start, length, period and
    exponent_milli of the longest run (ties: least start, then period; null
    without a run), runs_sha256, collapsed_sha256, n_words."""
    longest: Column = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("_best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("(1000 * _best.length) div -_best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
