"""Answer a table of session requests, known users by profile, new users
by the demographic model, invalid requests with their reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.coldstart import GenreModel, predict_genre_scores, recommend_new
from reelrank.operators.requests import classify_requests
from reelrank.operators.scoring import recommend_known
from reelrank.session import cut_lineage

OUTPUT = ["requestId", "userId", "path", "rank", "movieId", "title", "score", "occupation_unseen",
          "reject_reason"]


def recommend_session(requests: DataFrame, profiles: DataFrame, model: GenreModel,
                      items: DataFrame, k: int = 10) -> DataFrame:
    """requestId, userId, path ('known' / 'new' / 'rejected'), rank, movieId,
    title, score, occupation_unseen (1 where the model never saw a new user's
    occupation, else 0; null on the other paths), reject_reason; k rows per
    valid request, one per rejected."""
    # Read by all three paths: written once to the shared folder.
    classified = cut_lineage(classify_requests(requests, profiles))
    valid = classified.filter(F.col("reject_reason").isNull())
    known = valid.filter(F.col("is_known")).select("requestId", "userId")
    new = valid.filter(~F.col("is_known"))

    # Only the profiles somebody asked for are ranked.
    asked = profiles.join(known.select("userId").distinct(), "userId", "left_semi")
    known_out = known.join(recommend_known(asked, items, k), "userId").withColumns(
        {"path": F.lit("known"), "occupation_unseen": F.lit(None).cast("int")})

    scores = predict_genre_scores(model, new.select("requestId", "age", "gender", "occupation"))
    scores = cut_lineage(scores)
    new_out = (
        recommend_new(scores, items, k).join(new.select("requestId", "userId"), "requestId")
        .join(scores.select("requestId", "occupation_unseen"), "requestId")
        .withColumn("path", F.lit("new"))
    )
    rejected = classified.filter(F.col("reject_reason").isNotNull()).select(
        "requestId", "userId", F.lit("rejected").alias("path"), F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast("long").alias("movieId"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("occupation_unseen"),
        "reject_reason")
    answered = known_out.unionByName(new_out).withColumn("reject_reason", F.lit(None).cast("string"))
    return answered.select(*OUTPUT).unionByName(rejected.select(*OUTPUT))
