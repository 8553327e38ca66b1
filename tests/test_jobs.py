import os

from reelrank.plans import jobs
from reelrank.plans.catalog import Catalog, FileCatalog
from reelrank.session import scratch_path


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_item_and_ratings_jobs_on_files(spark, tmp_path):
    d = str(tmp_path)
    _write(f"{d}/ratings.tsv", "1\t10\t4\t5\n1\t10\t2\t3\n2\t10\t5\t9\n2\t11\t1\t9\n")
    flags_a = "|".join(["0", "1"] + ["0"] * 17)
    flags_b = "|".join(["0"] * 10 + ["1"] + ["0"] * 8)
    _write(f"{d}/items.psv", f"10|A (1990)|01-Jan-1990||u|{flags_a}\n11|B (1991)|01-Jan-1991||u|{flags_b}\n"
                          f"12|C (1992)|01-Jan-1992||u|{flags_b}\n")
    c = FileCatalog(spark, f"{d}/ratings.tsv", f"{d}/items.psv")
    out = scratch_path(spark, "jobs")
    checks = {r.check_name: r.value for r in jobs.item_table_job(c, out).collect()}
    assert checks["non_empty"] == 3
    movies = {r.movieId: r for r in spark.read.parquet(os.path.join(out, "movies")).collect()}
    assert movies[10].avg_rating == 4.5 and movies[10].action == 1
    assert movies[12].avg_rating is None and movies[11].film_noir == 1
    checks = {r.check_name: r.value for r in jobs.ratings_job(c, out).collect()}
    assert checks["non_empty"] == 3


def test_als_job_on_test_tables(spark, sf_small):
    out = scratch_path(spark, "als")
    rmse = jobs.als_job(Catalog(spark, sf_small), out).first()
    assert rmse.metric == "rmse" and rmse.value > 0
    nested = spark.read.parquet(os.path.join(out, "recommendations"))
    assert nested.count() > 0 and "recommendations" in nested.columns


def test_profile_session_and_title_jobs_on_test_tables(spark, sf_small):
    c = Catalog(spark, sf_small)
    out = scratch_path(spark, "prof")
    jobs.profile_job(c, out, num_trees=3, max_depth=5)
    checks = {r.check_name: r.value for r in jobs.session_job(c, out).collect()}
    answers = spark.read.parquet(os.path.join(out, "session_answers"))
    assert checks["non_empty"] == answers.count() > 0
    paths = {r.path for r in answers.select("path").distinct().collect()}
    assert {"known", "new"} <= paths
    docs = spark.read.parquet(os.path.join(out, "session_documents"))
    assert docs.count() == answers.filter("path <> 'rejected'").select("requestId").distinct().count()
    titles = spark.createDataFrame([("red bolt",), ("nothing at all",)], "query string")
    jobs.titles_job(c, out, titles=titles)
    got = spark.read.parquet(os.path.join(out, "title_answers"))
    assert {r.query for r in got.collect()} == {"red bolt"}


def test_command_line_entry_point(spark, sf_small, capsys):
    out = scratch_path(spark, "cli")
    jobs.main(["items", "--tables", sf_small, "--out", out])
    assert "non_empty" in capsys.readouterr().out
    assert spark.read.parquet(os.path.join(out, "movies")).count() > 0


def test_splits_job_publishes_every_pair_in_order(spark, sf_small):
    out = scratch_path(spark, "splits-job")
    checks = {r.check_name: r.value for r in jobs.splits_job(Catalog(spark, sf_small), out).collect()}
    names = {f"u{i}" for i in range(1, 6)} | {"ua", "ub"}
    path = os.path.join(out, "splits").removeprefix("file:")
    assert {d.split("=")[1] for d in os.listdir(path) if d.startswith("set_name=")} == names
    assert checks["non_empty"] == 7 * Catalog(spark, sf_small).ratings.count()
    files = spark.read.parquet(path).selectExpr("input_file_name() f", "set_name", "part", "userId", "movieId",
                                                "monotonically_increasing_id() i").collect()
    by_file = {}
    for r in sorted(files, key=lambda r: r.i):
        by_file.setdefault(r.f, []).append((r.userId, r.movieId))
    assert all(rows == sorted(rows) for rows in by_file.values())


def test_session_documents_carry_the_user_and_titles_read_als_lists(spark, sf_small):
    import json

    c, out = Catalog(spark, sf_small), scratch_path(spark, "docs")
    jobs.profile_job(c, out, num_trees=2, max_depth=3)
    jobs.session_job(c, out)
    docs = {r.requestId: json.loads(r.answer) for r in
            spark.read.parquet(os.path.join(out, "session_documents")).collect()}
    assert all(set(d) == {"userId", "recommendations"} for d in docs.values())
    assert all(d["userId"] == (r // 2 if r % 2 == 0 else None) for r, d in docs.items())
    jobs.als_job(c, out)
    titles = spark.createDataFrame([("red bolt",)], "query string")
    jobs.titles_job(c, out, titles=titles, lists="als")
    answer = json.loads(spark.read.parquet(os.path.join(out, "title_documents")).first().answer)
    assert answer["movie_title"] == "red bolt" and 0 < len(answer["recommendations"]) <= 10


def test_corrupt_rows_are_counted_and_failed_checks_exit(spark, tmp_path, capsys):
    import pytest

    d = str(tmp_path)
    flags = "|".join(["0", "7"] + ["0"] * 17)
    _write(f"{d}/r.tsv", "1\t10\t4\t5\n1\tnot a number\t4\t5\n")
    _write(f"{d}/i.psv", f"10|A (1990)|01-Jan-1990||u|{flags}\n")
    checks = {r.check_name: r.value for r in FileCatalog(spark, f"{d}/r.tsv", f"{d}/i.psv").input_checks().collect()}
    assert checks == {"corrupt_ratings": 1, "corrupt_items": 0, "invalid_flags": 1}
    jobs.main(["items", "--ratings", f"{d}/r.tsv", "--items", f"{d}/i.psv", "--out", scratch_path(spark, "ok")])
    assert "corrupt_ratings" in capsys.readouterr().out
    _write(f"{d}/empty.tsv", "")
    with pytest.raises(SystemExit, match="a check failed"):
        jobs.main(["ratings", "--ratings", f"{d}/empty.tsv", "--items", f"{d}/i.psv", "--out", scratch_path(spark, "bad")])
