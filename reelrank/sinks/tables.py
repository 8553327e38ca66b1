"""K1 publish a table (replace all content) and K5 post-write checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("value", T.LongType()),
])


def publish(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
            partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
            **options: str) -> str:
    """Write ``df`` to ``path`` (one action). Parquet by default; ``fmt`` may
    name any installed data source (JSON lines for a document store, a
    connector's format name). ``sort_within`` orders rows inside each output
    file (the sorted files of the original split scripts) without a global
    sort."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def publish_sorted(df: DataFrame, path: str, by: Sequence[str], partition_by: Sequence[str] = (),
                   fmt: str = "parquet", ranged: bool = False) -> str:
    """Write with files in global order of ``by`` (inside each value of
    ``partition_by``): range-partitioned, so the rows of a heavy user are
    several files, then sorted within each. ``ranged``: the rows already lie in
    ranges of ``by`` and are not shuffled again."""
    keys = [*partition_by, *by]
    return publish(df if ranged else df.repartitionByRange(*keys), path, fmt, partition_by=partition_by, sort_within=keys)


def publish_checks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """K5: ``check_name, passed, value`` rows: the table exists, and it has
    rows (value = row count). The count is a distributed aggregate."""
    try:
        table = spark.read.format(fmt).load(path)
    except AnalysisException:
        return spark.createDataFrame([("exists", False, None), ("non_empty", False, 0)], CHECK_SCHEMA)
    n = table.agg(F.count(F.lit(1)).alias("n"))
    rows = F.array(
        F.struct(F.lit("exists").alias("check_name"), F.lit(True).alias("passed"),
                 F.lit(None).cast("long").alias("value")),
        F.struct(F.lit("non_empty").alias("check_name"), (F.col("n") > 0).alias("passed"),
                 F.col("n").alias("value")),
    )
    return n.select(F.inline(rows))


def publish_bucketed(df: DataFrame, name: str, path: str, bucket_col: str, buckets: int,
                     sort_within: Sequence[str] = (), fmt: str = "parquet") -> str:
    """K1 as a catalogue table bucketed by ``bucket_col`` (files under
    ``path`` on shared storage). Later aggregations and joins on that column
    read the buckets as partitions and skip their shuffle; ``buckets`` should
    follow the data size (e.g. ``sized_settings``). A bucket is one task: a
    user with a large share of the rows makes one bucket large; use
    :func:`publish_sorted` for such data."""
    writer = df.write.mode("overwrite").format(fmt).option("path", path).bucketBy(buckets, bucket_col)
    if sort_within:
        writer = writer.sortBy(*sort_within)
    writer.saveAsTable(name)
    return name
