import os

import pytest

from reelrank.session import scratch_path
from reelrank.sinks import tables
from reelrank.sources import read_items, read_ratings, read_users


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_delimited_readers(spark, tmp_path):
    d = str(tmp_path)
    _write(f"{d}/ratings.tsv", "1\t10\t4\t881250949\n2\t10\tx\t881250950\n")
    _write(f"{d}/items.psv", "10|Café Noir (1950)|01-Jan-1950||http://x|0|1|0|0|0|0|0|0|0|0|1|0|0|0|0|1|0|0|0\n")
    _write(f"{d}/users.psv", "1|24|M|technician|85711\n2|53|F|other|L9G2B\n")
    r = read_ratings(spark, f"{d}/ratings.tsv").collect()
    assert r[0].rating == 4 and r[1].rating is None and r[1]["_corrupt"] is not None
    it = read_items(spark, f"{d}/items.psv").first()
    assert it.title == "Café Noir (1950)" and it.action == "1" and it.film_noir == "1"
    u = read_users(spark, f"{d}/users.psv").collect()
    assert u[1].zipcode == "L9G2B"


def test_missing_input_fails_early(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="ratings"):
        read_ratings(spark, str(tmp_path / "nope" / "ratings.tsv"))


def test_publish_and_checks(spark):
    df = spark.range(5).withColumnRenamed("id", "movieId")
    path = tables.publish(df, scratch_path(spark, "t"), sort_within=["movieId"])
    checks = {r.check_name: r for r in tables.publish_checks(spark, path).collect()}
    assert checks["exists"].passed and checks["non_empty"].value == 5
    missing = {r.check_name: r for r in tables.publish_checks(spark, path + "-missing").collect()}
    assert not missing["exists"].passed and not missing["non_empty"].passed
