"""Read a published table back (the inverse of ``sinks.publish``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.sinks.snapshots import current


def read_published(spark: SparkSession, path: str, fmt: str = "parquet",
                   **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The newest whole version of a table published by ``sinks.snapshots``."""
    return read_published(spark, current(spark, path), fmt, **options)


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """_index, _id, doc (JSON text) of the newest whole version of bulk files.
    A record begins with its action, so files are split anywhere: the action's
    first characters part the records. (Quotes inside texts are escaped, so only a document with a
    field ``index`` that begins with ``_index`` could hold them.)"""
    begin = '{"index":{"_index":'
    records = read_snapshot(spark, path, "text", lineSep=begin).filter("value <> ''")
    head = F.from_json(F.concat(F.lit(begin), F.substring_index("value", "\n", 1)), "index struct<_index: string, _id: string>")
    doc = F.rtrim(F.expr("substring(value, instr(value, '\n') + 1)"), F.lit("\n"))
    return records.select(head["index"]["_index"].alias("_index"), head["index"]["_id"].alias("_id"), doc.alias("doc"))
