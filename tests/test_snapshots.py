"""Published versions: replaced as a whole or not at all; bulk files of documents."""

import json
import os

import pytest
from pyspark.sql import functions as F

from reelrank.session import scratch_path
from reelrank.sinks.documents import bulk_lines, publish_bulk
from reelrank.sinks.snapshots import current, publish_snapshot, versions
from reelrank.sources.published import read_bulk, read_snapshot


@pytest.fixture
def path(spark):
    return scratch_path(spark, "snapshot-test")


def test_newest_whole_version_is_read_and_old_ones_go(spark, path):
    for n in (3, 4, 5, 6):
        publish_snapshot(spark.range(n), path, keep=2)
    assert read_snapshot(spark, path).count() == 6
    assert versions(spark, path) == {3: True, 4: True}


def test_a_failing_partition_leaves_the_table_as_it_was(spark, path):
    publish_snapshot(spark.range(5), path)
    bad = spark.range(100).repartition(4).select(F.expr("CASE WHEN id = 57 THEN raise_error('lost') ELSE id END").cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_snapshot(bad, path)
    assert read_snapshot(spark, path).count() == 5
    publish_snapshot(spark.range(7), path, keep=1)
    assert read_snapshot(spark, path).count() == 7 and list(versions(spark, path).values()) == [True]


def test_a_job_killed_before_its_commit_is_not_read(spark, path):
    first = publish_snapshot(spark.range(5), path)
    second = publish_snapshot(spark.range(9), path)
    os.remove(os.path.join(second.removeprefix("file:"), "_SUCCESS"))  # as a job leaves it that is killed before the commit's end
    assert current(spark, path) == first and read_snapshot(spark, path).count() == 5
    third = publish_snapshot(spark.range(2), path)
    assert third != second and read_snapshot(spark, path).count() == 2


def test_nothing_published_yet(spark, path):
    assert versions(spark, path) == {}
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    with pytest.raises(ValueError):
        publish_snapshot(spark.range(1), path, keep=0)


def test_bulk_files_round_trip(spark, path):
    rows = [(i, json.dumps({"title": t, "n": i})) for i, t in enumerate(
        ["plain", 'quote " and {"index":{"_index": inside', "line\nbreak", "é 漢", ""] * 40)]
    docs = spark.createDataFrame(rows + [(None, "{}"), (999, None)], "id long, doc string").repartition(5)
    folder = publish_bulk(docs, path, "movies", "id", "doc")
    got = {int(r["_id"]): (r["_index"], r["doc"]) for r in read_bulk(spark, path).collect()}
    assert got == {i: ("movies", d) for i, d in rows}
    lines = [line for f in sorted(os.listdir(folder.removeprefix("file:"))) if f.startswith("part-")
             for line in open(os.path.join(folder.removeprefix("file:"), f), encoding="utf-8").read().splitlines()]
    assert len(lines) == 2 * len(rows)
    assert all(json.loads(a)["index"]["_index"] == "movies" and json.loads(d) for a, d in zip(lines[::2], lines[1::2]))


def test_bulk_records_survive_small_splits(spark, path):
    rows = [(i, json.dumps({"t": "x" * (i % 37)})) for i in range(500)]
    publish_bulk(spark.createDataFrame(rows, "id long, doc string").coalesce(1), path, "i", "id", "doc")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
        df = read_bulk(spark, path)
        assert df.rdd.getNumPartitions() > 10
        assert {(int(r["_id"]), r["doc"]) for r in df.collect()} == set(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bulk_lines_escape_ids(spark):
    row = bulk_lines(spark.createDataFrame([('a"b', "{}")], "id string, doc string"), "x", "id", "doc").first().value
    assert json.loads(row.split("\n")[0]) == {"index": {"_index": "x", "_id": 'a"b'}}
