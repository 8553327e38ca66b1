from pyspark.sql import types as T

from reelrank.operators.requests import classify_requests

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                       ["requestId", "userId", "gender", "occupation", "age"]])


def test_reject_reasons_and_normalisation(spark):
    profiles = spark.createDataFrame([(1,)], "userId long")
    reqs = spark.createDataFrame([
        ("a", "1", None, None, None),             # known user: nothing else needed
        ("b", None, "f", "Writer", "31"),         # new user, complete form
        ("c", None, "m", "writer", None),         # new user without age
        ("d", None, "m", "writer", "thirty"),     # age not a number
        ("e", "x1", "m", "writer", "30"),         # id not a number
        ("f", "5", "m", "astronaut", "40"),       # id without profile, unseen occupation: valid
        ("g", None, None, "", "22"),              # missing gender and occupation
    ], SCHEMA)
    out = {r.requestId: r for r in classify_requests(reqs, profiles).collect()}
    assert out["a"].is_known and out["a"].reject_reason is None
    assert out["b"].gender == "F" and out["b"].occupation == "writer" and out["b"].age == 31
    assert out["b"].reject_reason is None and not out["b"].is_known
    assert out["c"].reject_reason == "missing for a new user: age"
    assert out["d"].reject_reason == "age is not a number"
    assert out["e"].reject_reason == "userId is not a number"
    assert out["f"].reject_reason is None and not out["f"].is_known
    assert out["g"].reject_reason == "missing for a new user: gender, occupation"


def test_every_customer_asks_with_and_without_an_id(spark, sf_small):
    from reelrank.plans.catalog import Catalog

    c = Catalog(spark, sf_small)
    out = classify_requests(c.requests, c.profiles)
    n = c.all_users.count()
    assert out.count() == 2 * n
    assert out.filter("userId IS NULL").count() == n
    assert out.filter("is_known").count() == c.profiles.count() == c.ratings.select("userId").distinct().count()
