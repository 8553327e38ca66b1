"""Global row numbers without moving all rows into one partition.

``row_number()`` over an un-partitioned window sends every row to a single
task. Instead: range-partition on the (total) order, sort inside each
partition, take each row's position inside its partition, and add the number
of rows in all earlier partitions. The per-partition counts are one row per
partition, so the offset table is bounded by the partition count, not by the
data. The numbered rows are checkpointed into the shared checkpoint folder
first so that counts and rows come from the same materialised partitions
(AQE may otherwise split or merge them differently for the two reads).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` (must be a
    total order over the rows for the numbering to be deterministic)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = cut_lineage(tagged.select(
        *df.columns,
        F.shiftright("_mid", _LOCAL_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_pos"),
    ))
    counts = tagged.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition: the running total runs in one task by design.
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"),
    ).fillna(0, subset=["_offset"])
    numbered = tagged.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_pos") + 1).alias(name))
