"""Repeated runs of lines, found by prefix doubling over line-id sequences.

Each document is a sequence of line ids (blank lines aside). Lines that occur
once cannot be part of a repeat; they end the runs around them and take no
part in the sorting. All other positions are suffixes. Their ranks are made by
prefix doubling: ranks by the first line, then, from the pair (rank of the
suffix, rank of the suffix 2^r lines on), ranks by twice as many lines. One
doubling aggregates equal pairs map-side, sorts the distinct pairs by range,
and numbers them by running counts: rank = suffixes that are smaller. After
the doublings needed for ``depth`` lines, suffixes of equal rank are
the intervals of the suffix array whose longest common prefix is at least
``depth``; the first suffix of an interval is its earliest copy, each other
suffix starts a later copy of a run of that many lines. Overlapping copies
chain to maximal runs.

A run counts if it has at least ``min_lines`` lines, or at least one line of
``min_words`` words. Later copies are deleted, the earliest stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import kept, materialise, summed_ranks, unused

MIN_LINES = 2
MIN_WORDS = 10
_BLANK = " \t\r\x0b\x0c"
#: What identifies a document: its doc_id (null last) and a hash of its text.
ROW = ["none", "id", "h"]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("text").alias("h"))


def _lines(text: str | Column) -> Column:
    """The lines of a text that are not blank, trimmed at both ends."""
    trimmed = F.transform(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(_BLANK)))
    return F.filter(trimmed, lambda line: line != "")


def line_table(rows: DataFrame) -> DataFrame:
    """(none, id, h, seq, x, y, words): every line that is not blank, numbered
    from 0 within its document, with a 128-bit id of its content."""
    lines = rows.select(*ROW, F.posexplode(_lines("text")).alias("seq", "line"))
    return lines.select(
        *ROW, "seq", F.xxhash64("line").alias("x"), F.xxhash64(F.lit(7), F.col("line")).alias("y"),
        F.size(F.split("line", r"[\x20\x09-\x0D]+")).alias("words"),
    ).dropDuplicates([*ROW, "seq"])


def first_ranks(lines: DataFrame) -> DataFrame:
    """Suffixes ranked by their first line; lines that occur once are left out."""
    repeated = lines.groupBy("x", "y").agg(F.count("*").alias("n")).filter("n > 1")
    return lines.join(summed_ranks(repeated, ["x", "y"]).drop("n"), ["x", "y"]).drop("x", "y")


def doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Suffixes ranked by ``step`` more lines than before: by the pair (rank,
    rank of the suffix ``step`` lines on). A suffix without such a partner, or
    whose pair occurs once, starts no longer repeat and is left out."""
    on = ranks.select(*ROW, (F.col("seq") - step).alias("seq"), F.col("rank").alias("next"))
    pairs = ranks.withColumnRenamed("rank", "head").join(on, [*ROW, "seq"])
    counted = pairs.groupBy("head", "next").agg(F.count("*").alias("n")).filter("n > 1")
    return (pairs.join(summed_ranks(counted, ["head", "next"]).drop("n"), ["head", "next"])
            .drop("head", "next"))


def _later(ranks: DataFrame) -> DataFrame:
    """Suffixes that are not the earliest of their interval. The heads are
    written first: a join of two plain exchanges lets Spark split a hot interval."""
    place = F.struct(*ROW, "seq")
    first = materialise(ranks.groupBy("rank").agg(F.min(place).alias("first")), "run-heads")
    return ranks.join(first, "rank").filter(F.col("first") != place).select(*ROW, "seq")


def repeated_lines(rows: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(none, id, h, seq) of the lines that later copies of repeated runs cover."""
    ranks = materialise(first_ranks(line_table(rows)), "ranks-1")
    found = _later(ranks).join(
        ranks.filter(F.col("words") >= min_words).select(*ROW, "seq"), [*ROW, "seq"])
    depth = 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        ranks = materialise(doubled(ranks, step), f"ranks-{depth + step}")
        depth += step
    runs = _later(ranks).select(*ROW, F.explode(
        F.sequence(F.col("seq"), F.col("seq") + (min_lines - 1))).alias("seq"))
    return found.union(runs).distinct()


def _without(text: str, gone: np.ndarray) -> str:
    """The text without the lines that are not blank and numbered in ``gone``."""
    drop, kept, seq = set(gone.tolist()), [], 0
    for line in text.split("\n"):
        if line.strip(_BLANK):
            if seq not in drop:
                kept.append(line)
            seq += 1
        else:
            kept.append(line)
    return "\n".join(kept)


def _cut_lines(text: str, gone: str) -> Column:
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept("line_dedup")
        for texts, numbers in batches:
            yield pd.Series([t if t is None or g is None else _without(t, g)
                             for t, g in zip(texts, numbers)], dtype=object)

    return F.pandas_udf(cut, "string")(text, gone)


def _count(array: Column) -> Column:
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array)).cast("long")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_lines, n_removed, n_runs, kept_text.

    A line is trimmed of white space before it is compared and kept as it is.
    "Earlier" means smaller doc_id (null last), then, among rows of one doc_id,
    the text's hash, then the line's place. Blank lines are kept; they do not
    count and do not end a run. A null text stays null with no lines. Rows
    equal in doc_id and text are one document: each comes back with the same
    result. No other column is read.
    """
    rows = _rows(docs)
    gone = repeated_lines(rows, min_lines, min_words).groupBy(*ROW).agg(
        F.sort_array(F.collect_list("seq")).alias("gone"))
    joined = rows.join(gone, ROW, "left")
    starts = F.filter("gone", lambda seq, i: F.when(i == 0, True).otherwise(
        seq - F.element_at("gone", F.greatest(i, F.lit(1))) > 1))
    return joined.select(
        "doc_id", _count(_lines("text")).alias("n_lines"), _count(F.col("gone")).alias("n_removed"),
        _count(starts).alias("n_runs"),
        _cut_lines("text", "gone").alias("kept_text"))


def apply(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with their repeated lines cut, all columns kept; ``n_chars``, if
    present, is counted anew where lines went. A document that consisted of
    later copies only is dropped; one that had no lines before stays."""
    none, id_, h, gone = unused(docs.columns, "none", "id", "h", "gone")
    rows = docs.withColumns({
        none: F.col("doc_id").isNull(), id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        h: F.xxhash64("text")})
    found = repeated_lines(_rows(docs), min_lines, min_words).groupBy(*ROW).agg(
        F.sort_array(F.collect_list("seq")).alias("seqs")).toDF(none, id_, h, gone)
    joined = rows.join(found, [none, id_, h], "left").filter(
        F.col(gone).isNull() | (F.size(gone) < F.size(_lines("text"))))
    cut = joined.withColumn("text", _cut_lines("text", gone))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(
            F.col(gone).isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars")))
    return cut.select(docs.columns)
