"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.session import scratch_path

#: White space that separates words: space and the controls 0x09 to 0x0D.
WORD_BYTES = rb"[^\x20\x09-\x0D]+"
#: Bytes of a row group of the tables written between stages.
ROW_GROUP = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    This cuts the lineage with a table every executor can reach: work above
    it is not repeated, and a lost executor costs no earlier stage.
    """
    path = scratch_path(df.sparkSession, name)
    # small row groups: a writer holds one of whole texts in memory
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """``names`` with as many underscores in front as make all of them new."""
    taken, prefix = {c.lower() for c in columns}, "_"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def summed_ranks(pairs: DataFrame, order: list[str]) -> DataFrame:
    """Distinct keys with their ``n`` -> the keys and ``rank`` = the sum of ``n``
    over all smaller keys. Range-partitioned; one offset row per partition."""
    cut = pairs.repartitionByRange(partitions(pairs.sparkSession), *order).withColumn(
        "part", F.spark_partition_id())
    cut = materialise(cut, "rank-keys")
    totals = cut.groupBy("part").agg(F.sum("n").alias("t"))
    offsets = totals.select("part", F.coalesce(
        F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("o"))
    before = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1))
    return (cut.withColumn("b", F.coalesce(before, F.lit(0))).join(F.broadcast(offsets), "part")
            .select(*order, "n", (F.col("o") + F.col("b")).alias("rank")))


_KEPT: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any] = lambda: None) -> Any:
    """What a Python worker keeps from task to task: one thing at a time.

    The tables of an operator (automata, memos) are released as soon as a task
    of another one runs in the worker, so they never add up. Operators without
    tables call it with their name only.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` texts in an Arrow batch: a worker holds one batch of whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
