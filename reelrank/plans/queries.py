"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory. Each reads the whole test tables under
``sf_dir`` through :class:`~reelrank.plans.catalog.Catalog`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.operators import (
    cleaning,
    coldstart,
    collaborative,
    evaluation,
    requests,
    scoring,
    search,
    sessions,
    splits,
)
from reelrank.operators import items as item_ops
from reelrank.operators import profiles as profile_ops
from reelrank.session import cut_lineage, scratch_path
from reelrank.sinks import documents, tables
from reelrank.sinks.snapshots import publish_snapshot
from reelrank.plans.catalog import Catalog
from reelrank.sources import read_published
from reelrank.sources.published import read_bulk, read_snapshot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
        QUERIES[name] = lambda spark, root: fn(Catalog(spark, root))
        return fn
    return register


@query("item_table")
def q_item_table(c: Catalog) -> DataFrame:
    """Clean, aggregate, left join, project (flagship)."""
    return item_ops.item_table(c.items, c.ratings)


# --- scans (S1-S3 over the adapter) ----------------------------------------
@query("scan_ratings")
def q_scan_ratings(c: Catalog) -> DataFrame:
    return c.rating_events.select("userId", "movieId", "rating", "timestamp")


@query("scan_items")
def q_scan_items(c: Catalog) -> DataFrame:
    return c.items_raw


@query("scan_users")
def q_scan_users(c: Catalog) -> DataFrame:
    return c.all_users


# --- cleaning (P3, P5, A3) --------------------------------------------------
@query("clean_ratings")
def q_clean_ratings(c: Catalog) -> DataFrame:
    """R7 / P5 + A3: null ratings dropped, latest rating per (user, item)."""
    return c.ratings


@query("dedup_ratings")
def q_dedup_ratings(c: Catalog) -> DataFrame:
    """A3 alone, source tie-break columns kept."""
    return cleaning.keep_latest(c.rating_events, cleaning.RATING_KEY, cleaning.RATING_ORDER)


@query("dedup_items")
def q_dedup_items(c: Catalog) -> DataFrame:
    """A3 for items, over items as the rating events show them: one raw item
    row per event, so an item repeats as often as it was rated."""
    seen = c.rating_events.select("movieId").join(c.items_raw, "movieId")
    return cleaning.dedup_items(seen)


@query("item_flags")
def q_item_flags(c: Catalog) -> DataFrame:
    """Text flags cast to int with try_cast, invalid ones counted."""
    return cleaning.cast_flags(c.items_raw)


# --- item statistics (A1, J1, P15) -------------------------------------------
@query("item_avg_rating")
def q_item_avg_rating(c: Catalog) -> DataFrame:
    return item_ops.item_avg_rating(c.ratings)


@query("item_stats_left_join")
def q_item_stats_left_join(c: Catalog) -> DataFrame:
    """An item without a rating keeps a null average."""
    return item_ops.item_stats(c.items, c.ratings)


@query("item_genres_long")
def q_item_genres_long(c: Catalog) -> DataFrame:
    return item_ops.item_genres_long(c.items)


# --- profiles (J2, J3, A2, A2b, P6) ------------------------------------------
@query("rating_facts")
def q_rating_facts(c: Catalog) -> DataFrame:
    return profile_ops.rating_facts(c.ratings, c.items, c.users)


@query("user_genre_profile")
def q_user_genre_profile(c: Catalog) -> DataFrame:
    """A2 / R6."""
    return c.profiles


@query("user_genre_profile_long")
def q_user_genre_profile_long(c: Catalog) -> DataFrame:
    return profile_ops.user_genre_profile_long(c.ratings, c.items, c.users)


@query("profile_targets")
def q_profile_targets(c: Catalog) -> DataFrame:
    return profile_ops.profile_targets(c.profiles)


# --- ranking (R1, K4) ---------------------------------------------------------
@query("recommend_known")
def q_recommend_known(c: Catalog) -> DataFrame:
    return scoring.recommend_known(c.profiles, c.items, k=10)


@query("answer_documents")
def q_answer_documents(c: Catalog) -> DataFrame:
    return documents.answer_documents(scoring.recommend_known(c.profiles, c.items, k=10), "userId")


# --- requests (P12, P13, J5) --------------------------------------------------
@query("requests_clean")
def q_requests_clean(c: Catalog) -> DataFrame:
    """Normalised request fields."""
    return requests.normalise_requests(c.requests).drop("_has_user", "_has_age")


@query("requests_known_new")
def q_requests_known_new(c: Catalog) -> DataFrame:
    """requestId, userId, is_known."""
    return requests.classify_requests(c.requests, c.profiles).select("requestId", "userId", "is_known")


@query("requests_rejected")
def q_requests_rejected(c: Catalog) -> DataFrame:
    """Rejected requests with their reason."""
    classified = requests.classify_requests(c.requests, c.profiles)
    return classified.filter("reject_reason IS NOT NULL").select("requestId", "reject_reason")


# --- search (P16, R4) ---------------------------------------------------------
@query("title_search")
def q_title_search(c: Catalog) -> DataFrame:
    return search.title_search(c.items, c.title_queries, k=10)


@query("recommend_by_title")
def q_recommend_by_title(c: Catalog) -> DataFrame:
    """R4 over profile-based lists (R1, top 10), built only for the raters of
    the matched items."""
    def lists_for(users: DataFrame) -> DataFrame:
        return scoring.recommend_known(c.profiles.join(users, "userId", "left_semi"), c.items, k=10)
    return search.recommend_by_title(c.items, c.title_queries, c.ratings, lists_for, k=10)


@query("title_documents")
def q_title_documents(c: Catalog) -> DataFrame:
    """K4 for R4: one document per title query over the profile-based lists."""
    return documents.title_documents(q_recommend_by_title(c))


@query("title_answers")
def q_title_answers(c: Catalog) -> DataFrame:
    """K4 for R4 with an answer to every query: titles of items and names of
    nations, of which most match no title."""
    asked = c.title_queries.unionByName(c.tables.table("nation").select(F.col("n_name").alias("query")))

    def lists_for(users: DataFrame) -> DataFrame:
        return scoring.recommend_known(c.profiles.join(users, "userId", "left_semi"), c.items, k=10)
    return documents.title_answer_documents(search.title_answers(c.items, asked, c.ratings, lists_for, k=10))


# --- splits and evaluation (X1-X3, A6) ---------------------------------------
@query("split_random")
def q_split_random(c: Catalog) -> DataFrame:
    return splits.split_random(c.ratings, (0.8, 0.2), seed=42)


@query("split_random_check")
def q_split_random_check(c: Catalog) -> DataFrame:
    """Every rating is in exactly one part (computed from one materialised split)."""
    labelled = cut_lineage(splits.split_random(c.ratings, (0.8, 0.2), seed=42))
    pairs = labelled.groupBy("userId", "movieId").agg(F.count("*").alias("n"))
    missing = c.ratings.join(pairs, ["userId", "movieId"], "left_anti")
    return pairs.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("overlap")).crossJoin(
        F.broadcast(missing.agg(F.count("*").alias("missing"))))  # one row each


@query("split_hash")
def q_split_hash(c: Catalog) -> DataFrame:
    return splits.split_hash(c.ratings, 80)


@query("kfold_split")
def q_kfold_split(c: Catalog) -> DataFrame:
    return splits.kfold_split(c.ratings, k=5)


@query("leave_n_out")
def q_leave_n_out(c: Catalog) -> DataFrame:
    """First ten ratings of every user to test."""
    return splits.leave_n_out(c.ratings, start=1, stop=10)


@query("splits_roundtrip")
def q_splits_roundtrip(c: Catalog) -> DataFrame:
    """Every published base/test pair read back: rows, users and id sums of each."""
    path = tables.publish_sorted(splits.evaluation_sets(c.ratings), scratch_path(c.spark, "splits"),
                                 by=["userId", "movieId"], partition_by=["set_name", "part"], ranged=True)
    return read_published(c.spark, path).groupBy("set_name", "part").agg(
        F.count("*").alias("n_rows"), F.countDistinct("userId").alias("n_users"),
        F.sum("userId").alias("user_sum"), F.sum("movieId").alias("item_sum"))


@query("rmse_baseline")
def q_rmse_baseline(c: Catalog) -> DataFrame:
    """Item-mean predictor trained on the hash split."""
    return evaluation.rmse_item_mean(splits.split_hash(c.ratings, 80))


# --- sinks (K1, K5) -----------------------------------------------------------
@query("publish_roundtrip")
def q_publish_roundtrip(c: Catalog) -> DataFrame:
    """K1 then S5: the item table written and read back."""
    path = tables.publish(item_ops.item_table(c.items, c.ratings), scratch_path(c.spark, "items"))
    return read_published(c.spark, path)


@query("snapshot_roundtrip")
def q_snapshot_roundtrip(c: Catalog) -> DataFrame:
    """The items replaced by the item table in a second version, read back."""
    path = scratch_path(c.spark, "snapshots")
    publish_snapshot(c.items, path)
    publish_snapshot(item_ops.item_table(c.items, c.ratings), path)
    return read_snapshot(c.spark, path)


@query("bulk_roundtrip")
def q_bulk_roundtrip(c: Catalog) -> DataFrame:
    """K1, K4: answers as bulk files of documents with ids, read back."""
    path = scratch_path(c.spark, "bulk")
    answers = documents.answer_documents(scoring.recommend_known(c.profiles, c.items, k=10), "userId")
    documents.publish_bulk(answers, path, "answers", "userId", "answer")
    return read_bulk(c.spark, path).select(F.col("_id").cast("long").alias("userId"), F.col("doc").alias("answer"))


@query("publish_checks")
def q_publish_checks(c: Catalog) -> DataFrame:
    """K5 on the published item table."""
    path = tables.publish(item_ops.item_table(c.items, c.ratings), scratch_path(c.spark, "items"))
    return tables.publish_checks(c.spark, path)


# --- collaborative filtering (M1-M4) -----------------------------------------
def _als_split(c: Catalog):
    labelled = splits.split_hash(c.ratings_kept, 80)
    train = labelled.filter("split = 'train'").drop("split")
    test = labelled.filter("split = 'test'").drop("split")
    return train, test


@query("als_predictions")
def q_als_predictions(c: Catalog) -> DataFrame:
    """M2: scores of the test pairs."""
    train, test = _als_split(c)
    model = collaborative.fit_als(train, blocks=collaborative.BLOCKS, item_blocks=collaborative.FEW_ITEM_BLOCKS)
    return collaborative.als_predictions(model, test)


@query("als_rmse")
def q_als_rmse(c: Catalog) -> DataFrame:
    return evaluation.rmse(q_als_predictions(c))


@query("als_recommendations")
def q_als_recommendations(c: Catalog) -> DataFrame:
    """M4: all-user top 10 from ALS trained on all cleaned ratings."""
    return collaborative.als_recommendations(collaborative.fit_als(c.ratings), 10)


@query("als_recommendations_unseen")
def q_als_recommendations_unseen(c: Catalog) -> DataFrame:
    """M4 with exclude_seen: top 10 items each user has not rated."""
    return collaborative.als_recommendations_unseen(collaborative.fit_als(c.ratings_kept), c.ratings_kept, 10)


@query("als_predicted_pairs")
def q_als_predicted_pairs(c: Catalog) -> DataFrame:
    """M2 without the score: the test pairs that get a prediction."""
    return q_als_predictions(c).select("userId", "movieId", "rating")


def _list_check(recs: DataFrame, seen: DataFrame) -> DataFrame:
    """One row on top-10 lists: users, rows, users whose ranks are not 1..n in
    falling score, and rows that the user has rated."""
    recs = cut_lineage(recs)
    before = Window.partitionBy("userId").orderBy("rank")
    ordered = recs.withColumn("_up", F.coalesce(F.lag("rating").over(before) < F.col("rating"), F.lit(False)))
    users = ordered.groupBy("userId").agg(
        F.count("*").alias("n"), F.max("rank").alias("hi"), F.countDistinct("rank").alias("ranks"),
        F.max(F.col("_up").cast("int")).alias("up"))
    rated = recs.join(seen, ["userId", "movieId"], "left_semi").agg(F.count("*").alias("rated_rows"))
    return users.agg(
        F.count("*").alias("users"), F.sum("n").alias("n_rows"),
        F.sum(F.expr("int(hi <> n OR ranks <> n OR up = 1)")).cast("long").alias("wrong_ranks"),
    ).crossJoin(F.broadcast(rated))  # one row each


@query("als_lists_check")
def q_als_lists_check(c: Catalog) -> DataFrame:
    """M4: list length and order for every user."""
    lists = collaborative.als_recommendations(collaborative.fit_als(c.ratings_kept), 10)
    return _list_check(lists, c.ratings_kept).drop("rated_rows")


@query("als_unseen_check")
def q_als_unseen_check(c: Catalog) -> DataFrame:
    """M4 with exclude_seen: list length and order, and no rated item."""
    return _list_check(q_als_recommendations_unseen(c), c.ratings_kept)


# --- cold start (M5-M8, R2, R3) -----------------------------------------------
def _new_user_requests(c: Catalog, profiles: DataFrame) -> DataFrame:
    classified = requests.classify_requests(c.requests, profiles)
    return classified.filter("reject_reason IS NULL AND NOT is_known")


@query("demographic_onehot")
def q_demographic_onehot(c: Catalog) -> DataFrame:
    """M5 fitted on the profiled users, applied to every customer."""
    encoder = coldstart.demographic_encoder().fit(c.profiles)
    return coldstart.onehot_columns(c.all_users, coldstart.vocabulary(encoder))


@query("coldstart_genre_scores")
def q_coldstart_genre_scores(c: Catalog) -> DataFrame:
    profiles = cut_lineage(c.profiles)  # read for the model and for the lookup
    model = coldstart.fit_genre_model(profiles)
    return coldstart.predict_genre_scores(model, _new_user_requests(c, profiles))


@query("recommend_new")
def q_recommend_new(c: Catalog) -> DataFrame:
    profiles = cut_lineage(c.profiles)
    model = coldstart.fit_genre_model(profiles)
    scores = cut_lineage(coldstart.predict_genre_scores(model, _new_user_requests(c, profiles)))
    return coldstart.recommend_new(scores, c.items, 10)


@query("recommend_session")
def q_recommend_session(c: Catalog) -> DataFrame:
    profiles = cut_lineage(c.profiles)
    model = coldstart.fit_genre_model(profiles)
    return sessions.recommend_session(c.requests, profiles, model, c.items, 10)


@query("coldstart_check")
def q_coldstart_check(c: Catalog) -> DataFrame:
    """M6-M8, R2: answered requests, scores outside the targets' range, list rows and
    lists whose ranks are not 1..n in falling score."""
    profiles = cut_lineage(c.profiles)
    model = coldstart.fit_genre_model(profiles)
    scores = cut_lineage(coldstart.predict_genre_scores(model, _new_user_requests(c, profiles)))
    targets = profile_ops.profile_targets(profiles).select(
        F.array(*[F.col(p).cast("double") for p in profile_ops.PROFILE_COLUMNS]).alias("t"))
    span = targets.agg(F.min(F.array_min("t")).alias("lo"), F.max(F.array_max("t")).alias("hi"))
    each = coldstart.genre_scores_long(scores).crossJoin(F.broadcast(span))  # one row
    found = each.agg(
        F.countDistinct("requestId").alias("requests"), F.count("score").alias("n_scores"),
        F.sum(F.expr("int(score < lo - 1e-9 OR score > hi + 1e-9)")).cast("long").alias("out_of_range"))
    lists = coldstart.recommend_new(scores, c.items, 10).select(
        F.col("requestId").alias("userId"), "rank", "movieId", F.col("score").alias("rating"))
    none_seen = c.ratings.select("userId", "movieId").limit(0)
    return found.crossJoin(_list_check(lists, none_seen).select(
        F.col("n_rows").alias("list_rows"), "wrong_ranks"))


@query("session_check")
def q_session_check(c: Catalog) -> DataFrame:
    """Known and rejected rows exactly; of the new users' rows what does not
    depend on the model (request, path, rank)."""
    profiles = cut_lineage(c.profiles)
    model = coldstart.fit_genre_model(profiles)
    out = sessions.recommend_session(c.requests, profiles, model, c.items, 10)
    kept = [F.when(F.col("path") != "new", F.col(x)).alias(x) for x in ("movieId", "title", "score")]
    return out.select("requestId", "userId", "path", "rank", *kept, "occupation_unseen", "reject_reason")
