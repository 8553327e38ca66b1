"""K1 as snapshots: a published table is replaced as a whole or not at all.

Every publication is a new folder ``v-<number>`` below the table's path. Spark's
committer writes ``_SUCCESS`` into a folder when all its files are in place, so
the newest folder that holds it is the table. A job that fails or is killed
leaves a folder that no reader looks at, and the table as it was. Older
versions are kept by number.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"v-(\d{8})$")


def _folder(spark: SparkSession, path: str):
    """The path and its file system, whichever Spark's paths lead to."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(conf)


def versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version numbers below ``path`` in ascending order, and whether each is whole."""
    at, fs = _folder(spark, path)
    if not fs.exists(at):
        return {}
    found = {}
    for status in fs.listStatus(at):
        named = _VERSION.search(status.getPath().toString())
        if named and status.isDirectory():
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found[int(named[1])] = bool(fs.exists(done))
    return dict(sorted(found.items()))


def version_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/v-{number:08d}"


def current(spark: SparkSession, path: str) -> str:
    """The folder of the newest whole version."""
    whole = [n for n, done in versions(spark, path).items() if done]
    if not whole:
        raise FileNotFoundError(f"no published version below {path}")
    return version_path(path, whole[-1])


def publish_snapshot(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2, **options: str) -> str:
    """Write ``df`` as the next version (one action) and return its folder.
    ``keep`` whole versions stay, the new one among them; unfinished ones below
    them go. Two writers at once: the later one fails at the existing folder."""
    if keep < 1:
        raise ValueError("keep at least the version just written")
    spark = df.sparkSession
    number = max(versions(spark, path), default=0) + 1
    target = version_path(path, number)
    df.write.mode("errorifexists").format(fmt).options(**options).save(target)
    whole = [n for n, done in versions(spark, path).items() if done]
    for old in [n for n in versions(spark, path) if n < whole[-keep:][0]]:
        at, fs = _folder(spark, version_path(path, old))
        fs.delete(at, True)
    return target
