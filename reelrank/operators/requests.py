"""Recommendation requests: normalisation, validation, known/new split
(P12, P13, J5).

A request is a row of text fields as a form sends them: ``requestId``,
``userId`` (empty for a user without a profile), ``gender``, ``occupation``,
``age``. Rules (the original answered a bad request with an error; here it
becomes a row with a reason):

- ``userId`` present but not a whole number: rejected.
- the user has a profile: valid, the demographic fields are not needed.
- otherwise (no id, or an id without a profile): gender, occupation and age
  are required, and age must be a whole number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def normalise_requests(requests: DataFrame) -> DataFrame:
    """Ids and age to numbers (``try_cast``), gender upper-case,
    occupation lower-case, surrounding blanks removed."""
    def text(c: str) -> Column:
        return F.when(_blank(c), F.lit(None)).otherwise(F.trim(F.col(c)))

    return requests.select(
        "requestId",
        F.expr("try_cast(trim(userId) AS BIGINT)").alias("userId"),
        F.upper(text("gender")).alias("gender"),
        F.lower(text("occupation")).alias("occupation"),
        F.expr("try_cast(trim(age) AS INT)").alias("age"),
        (~_blank("userId")).alias("_has_user"),
        (~_blank("age")).alias("_has_age"),
    )


def mark_known(clean: DataFrame, profiles: DataFrame) -> DataFrame:
    """``is_known`` = a profile exists for the request's user.

    Requests without an id never take part in the join: null keys would all
    hash to one partition, so they are routed around it and unioned back."""
    ids = profiles.select("userId").distinct().withColumn("is_known", F.lit(True))
    with_id = clean.filter(F.col("userId").isNotNull())
    without_id = clean.filter(F.col("userId").isNull()).withColumn("is_known", F.lit(False))
    joined = with_id.join(ids, "userId", "left").withColumn(
        "is_known", F.coalesce(F.col("is_known"), F.lit(False)))
    return joined.unionByName(without_id)


def reject_reason() -> Column:
    """The first rule a request breaks, or null."""
    missing = [
        F.when(F.col("gender").isNull(), F.lit("gender")),
        F.when(F.col("occupation").isNull(), F.lit("occupation")),
        F.when(~F.col("_has_age"), F.lit("age")),
    ]
    missing_list = F.concat_ws(", ", *missing)
    return (
        F.when(F.col("_has_user") & F.col("userId").isNull(), F.lit("userId is not a number"))
        .when(F.col("is_known"), F.lit(None))
        .when(missing_list != "", F.concat(F.lit("missing for a new user: "), missing_list))
        .when(F.col("age").isNull(), F.lit("age is not a number"))
    )


def classify_requests(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """requestId, userId, gender, occupation, age, is_known, reject_reason."""
    marked = mark_known(normalise_requests(requests), profiles)
    return marked.select(
        "requestId", "userId", "gender", "occupation", "age", "is_known",
        reject_reason().alias("reject_reason"),
    )
