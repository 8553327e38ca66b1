"""The batch jobs of the original system, as functions and a command line.

Each job reads its inputs, builds one plan and writes its outputs with one
action per output. Inputs are either delimited files (``--ratings``,
``--items``, ``--users``) or a folder of the TPC-H-like test tables
(``--tables``). Outputs go below ``--out`` (Parquet unless ``--format``).

    python -m reelrank.plans.jobs items    --ratings ratings.tsv --items items.psv --out /shared/movies
    python -m reelrank.plans.jobs ratings  --ratings ratings.tsv --items items.psv --out /shared/ratings
    python -m reelrank.plans.jobs profiles --ratings ratings.tsv --items items.psv --users users.psv --out /shared/prof
    python -m reelrank.plans.jobs als      --ratings ratings.tsv --items items.psv --out /shared/recs
    python -m reelrank.plans.jobs session  --items items.psv --requests req.csv --out /shared/prof
    python -m reelrank.plans.jobs splits   --ratings ratings.tsv --items items.psv --out /shared/eval
    python -m reelrank.plans.jobs titles   --ratings ratings.tsv --items items.psv --titles t.txt --out /shared/prof

``session`` and ``titles`` read what ``profiles`` published under the same
``--out`` (profiles and the saved model).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators import coldstart, collaborative, evaluation, items, scoring, search, sessions, splits
from reelrank.plans.catalog import Catalog, FileCatalog
from reelrank.session import cut_lineage
from reelrank.sinks import documents, tables
from reelrank.sinks.preview import preview
from reelrank.sources import read_published

REQUEST_SCHEMA = "requestId string, userId string, gender string, occupation string, age string"


def item_table_job(c: Catalog, out: str, fmt: str = "parquet") -> DataFrame:
    """Clean, average per item, left join, publish ``movies``; then check it."""
    path = tables.publish(items.item_table(c.items, c.ratings), os.path.join(out, "movies"), fmt)
    return tables.publish_checks(c.spark, path, fmt)


def ratings_job(c: Catalog, out: str, fmt: str = "parquet", buckets: int | None = None) -> DataFrame:
    """Publish the cleaned ratings, files sorted by user and item. With
    ``buckets``, also register them as table ``ratings`` bucketed by user, so
    per-user aggregations over it need no shuffle."""
    path = os.path.join(out, "ratings")
    if buckets:
        tables.publish_bucketed(c.ratings, "ratings", path, "userId", buckets,
                                sort_within=["userId", "movieId"], fmt=fmt)
    else:
        tables.publish_sorted(c.ratings, path, ["userId", "movieId"], fmt=fmt)
    return tables.publish_checks(c.spark, path, fmt)


def profile_job(c: Catalog, out: str, fmt: str = "parquet", num_trees: int = coldstart.RF_NUM_TREES,
                max_depth: int = coldstart.RF_MAX_DEPTH) -> DataFrame:
    """Publish ``user_profiles`` and ``movies``, fit and save the cold-start model."""
    profiles = tables.publish(c.profiles, os.path.join(out, "user_profiles"), fmt)
    tables.publish(items.item_table(c.items, c.ratings), os.path.join(out, "movies"), fmt)
    saved = read_published(c.spark, profiles, fmt)
    model = coldstart.fit_genre_model(saved, num_trees=num_trees, max_depth=max_depth)
    coldstart.save_model(model, os.path.join(out, "genre_model"))
    return tables.publish_checks(c.spark, profiles, fmt)


def als_job(c: Catalog, out: str, fmt: str = "parquet", k: int = 10) -> DataFrame:
    """80/20 split, ALS fit, RMSE on the held-out part, top ``k`` for every
    user published nested (as the original) and long. Returns the RMSE row."""
    # The draw depends on partitions: written once, so both parts come from one draw.
    labelled = cut_lineage(splits.split_random(c.ratings, (0.8, 0.2), seed=collaborative.SPLIT_SEED))
    train = labelled.filter(F.col("split") == "train").drop("split")
    test = labelled.filter(F.col("split") == "test").drop("split")
    model = collaborative.fit_als(train)
    score = evaluation.rmse(collaborative.als_predictions(model, test))
    nested = tables.publish(collaborative.nested_recommendations(model, k), os.path.join(out, "recommendations"), fmt)
    tables.publish(collaborative.long_recommendations(read_published(c.spark, nested, fmt)),
                   os.path.join(out, "recommendations_long"), fmt)
    return score


def session_job(c: Catalog, out: str, fmt: str = "parquet", requests: DataFrame | None = None,
                k: int = 10) -> DataFrame:
    """Answer a table of session requests (known users by their published
    profile, new users by the saved model); publish long rows and one JSON
    answer per request. Returns the checks of the long table."""
    reqs = requests if requests is not None else c.requests
    profiles = read_published(c.spark, os.path.join(out, "user_profiles"), fmt)
    model = coldstart.load_model(os.path.join(out, "genre_model"))
    answers = sessions.recommend_session(reqs, profiles, model, c.items, k)
    path = tables.publish(answers, os.path.join(out, "session_answers"), fmt)
    ranked = read_published(c.spark, path, fmt).filter("path <> 'rejected'")
    tables.publish(documents.answer_documents(ranked, "requestId", doc_col="userId"), os.path.join(out, "session_documents"), fmt)
    return tables.publish_checks(c.spark, path, fmt)


def titles_job(c: Catalog, out: str, fmt: str = "parquet", titles: DataFrame | None = None,
               k: int = 10, lists: str = "profile") -> DataFrame:
    """For each title query: the items most often recommended to the raters
    of its best match, as rows; and one JSON answer for every query, with a reason
    where there is nothing to recommend. ``lists`` says
    whose lists: ranked from the published profiles (``profile``), or those the
    ``als`` job published (``als``)."""
    queries = titles if titles is not None else c.title_queries
    if lists == "als":
        stored = read_published(c.spark, os.path.join(out, "recommendations_long"), fmt)
    else:
        profiles = read_published(c.spark, os.path.join(out, "user_profiles"), fmt)

        def stored(users: DataFrame) -> DataFrame:
            return scoring.recommend_known(profiles.join(users, "userId", "left_semi"), c.items, k)

    answers = cut_lineage(search.title_answers(c.items, queries, c.ratings, stored, k))
    path = tables.publish(answers.filter("reason IS NULL").drop("reason"), os.path.join(out, "title_answers"), fmt)
    tables.publish(documents.title_answer_documents(answers), os.path.join(out, "title_documents"), fmt)
    return tables.publish_checks(c.spark, path, fmt)


def splits_job(c: Catalog, out: str, fmt: str = "parquet", k: int = 5, n: int = 10) -> DataFrame:
    """Publish base and test of every fold and of the two leave-n-out sets
    below ``splits``, one folder per set and part, in order of user and item."""
    path = tables.publish_sorted(splits.evaluation_sets(c.ratings, k, n), os.path.join(out, "splits"),
                                 ["userId", "movieId"], ["set_name", "part"], fmt)
    return tables.publish_checks(c.spark, path, fmt)


JOBS = {"splits": splits_job, "items": item_table_job, "ratings": ratings_job, "profiles": profile_job, "als": als_job,
        "session": session_job, "titles": titles_job}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="reelrank.plans.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--tables", help="folder of the TPC-H-like test tables")
    ap.add_argument("--ratings")
    ap.add_argument("--items")
    ap.add_argument("--users")
    ap.add_argument("--requests", help="CSV with header: requestId,userId,gender,occupation,age")
    ap.add_argument("--titles", help="text file, one title query per line")
    ap.add_argument("--buckets", type=int, help="ratings job: bucket the table by user")
    ap.add_argument("--lists", choices=["profile", "als"], default="profile", help="titles job: whose lists")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"reelrank-{args.job}").getOrCreate()
    if args.tables:
        catalog = Catalog(spark, args.tables)
    else:
        catalog = FileCatalog(spark, args.ratings, args.items, args.users)
    extra = {}
    if args.job == "session" and args.requests:
        extra["requests"] = spark.read.schema(REQUEST_SCHEMA).option("header", "true").csv(args.requests)
    if args.job == "titles" and args.titles:
        extra["titles"] = spark.read.text(args.titles).withColumnRenamed("value", "query")
    if args.job == "ratings" and args.buckets:
        extra["buckets"] = args.buckets
    if args.job == "titles":
        extra["lists"] = args.lists
    report = JOBS[args.job](catalog, args.out, args.format, **extra)
    if "passed" in report.columns and isinstance(catalog, FileCatalog):
        report = report.unionByName(catalog.input_checks())
    report = cut_lineage(report)
    preview(report, truncate=False)
    if "passed" in report.columns and not report.filter("NOT passed").isEmpty():
        sys.exit(f"{args.job}: a check failed")


if __name__ == "__main__":
    main()
