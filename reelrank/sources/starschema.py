"""Adapter from the TPC-H-like test tables to the recommendation model.

The engine's operators take plain DataFrames; this module derives them from
``lineitem``/``orders``/``part``/``customer`` so the same code runs on the
test data and on real rating files. Every rule here is a pure projection or
an equi-join, so Spark prunes columns down to the parquet scan.

Rules:
- rating event: a line item; user = ``o_custkey``, item = ``l_partkey``;
  rating = ``1 + (int(l_quantity) - 1) div 10`` (1..5); timestamp = epoch
  seconds of ``l_shipdate``; ``l_orderkey``/``l_linenumber`` are kept as a
  tie-break so "latest rating" is a total order.
- item: a part; title = ``p_name``; genre flags from the name's words and two
  ``p_type`` values (table below); ``unknown`` = 1 when no genre is set.
- user: a customer; age = ``round(c_acctbal / 100)``, gender from the parity
  of ``c_nationkey``, occupation = lower-case ``c_mktsegment``.
- requests: two per customer, one with the customer's id and one as the form
  sends it without an id. Whoever has a rating has a profile and is known;
  requests without an id are answered by the demographic model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.genres import GENRES, UNKNOWN

# Word of p_name (or value of p_type) that sets each genre flag, in genre order.
NAME_WORD_GENRE = {
    "anvil": "action", "blue": "adventure", "bolt": "animation",
    "cold": "children", "gear": "comedy", "gizmo": "crime",
    "hot": "documentary", "large": "drama", "new": "fantasy",
    "old": "film_noir", "plate": "horror", "red": "musical",
    "ring": "mystery", "rod": "romance", "small": "sci_fi",
    "widget": "thriller",
}
TYPE_GENRE = {"PROMO": "war", "STANDARD": "western"}

GENRE_SOURCE = {g: ("name", w) for w, g in NAME_WORD_GENRE.items()}
GENRE_SOURCE.update({g: ("type", t) for t, g in TYPE_GENRE.items()})
assert sorted(GENRE_SOURCE) == sorted(GENRES)


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    root: str
    _read: dict = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> DataFrame:
        """The table as a DataFrame, resolved once per ``Tables``."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        return self._read[name]


def epoch_seconds(ts: str) -> Column:
    """Epoch seconds of a TIMESTAMP or TIMESTAMP_NTZ, independent of time zone."""
    c = F.col(ts)
    day = F.unix_date(F.to_date(c)).cast("long") * 86400
    return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def rating_events(t: Tables) -> DataFrame:
    """Raw rating events with duplicates: userId, movieId, rating, timestamp,
    src_order, src_line."""
    li = t.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = t.table("orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return joined.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.lit(1) + F.floor((F.col("l_quantity").cast("int") - 1) / 10)).cast("int").alias("rating"),
        epoch_seconds("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").alias("src_order"),
        F.col("l_linenumber").alias("src_line"),
    )


def _genre_flag_sql(genre: str) -> str:
    kind, value = GENRE_SOURCE[genre]
    if kind == "name":
        return f"CAST(array_contains(_words, '{value}') AS INT) AS `{genre}`"
    return f"CAST(p_type = '{value}' AS INT) AS `{genre}`"


def items_raw(t: Tables) -> DataFrame:
    """Items as the delimited item file presents them: flags as text."""
    part = t.table("part").select("p_partkey", "p_name", "p_type", F.split("p_name", " ").alias("_words"))
    flagged = part.selectExpr("p_partkey", "p_name", *[_genre_flag_sql(g) for g in GENRES])
    any_flag = f"greatest({', '.join(f'`{g}`' for g in GENRES)})"
    return flagged.selectExpr(
        "p_partkey AS movieId",
        "p_name AS title",
        "CAST(NULL AS STRING) AS release_date",
        "CAST(NULL AS STRING) AS video_release_date",
        "CAST(NULL AS STRING) AS imdb_url",
        f"CASE WHEN {any_flag} = 0 THEN '1' ELSE '0' END AS `{UNKNOWN}`",
        *[f"CAST(`{g}` AS STRING) AS `{g}`" for g in GENRES],
    )


def customers_as_users(t: Tables) -> DataFrame:
    """All customers as users: userId, age, gender, occupation, zipcode."""
    c = t.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("userId"),
        F.round(F.col("c_acctbal") / 100).cast("int").alias("age"),
        F.when(F.col("c_nationkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.lower("c_mktsegment").alias("occupation"),
        F.col("c_name").alias("zipcode"),
    )


def session_requests(t: Tables) -> DataFrame:
    """Two recommendation requests per customer, as text fields of a form: the
    demographic fields with the user's id (even ``requestId``) and without it
    (odd). Whether a user is known is decided by the profile lookup. Text is
    left as typed (lower-case gender, capitalised occupation) for the
    normaliser to fix. Customers with a negative balance leave the age field
    empty, so their request without an id is incomplete and must be rejected.
    """
    c = t.table("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_anonymous")).select(
        (F.col("c_custkey") * 2 + F.col("_anonymous")).alias("requestId"),
        F.when(F.col("_anonymous") == 0, F.col("c_custkey").cast("string")).alias("userId"),
        F.when(F.col("c_nationkey") % 2 == 0, "m").otherwise("f").alias("gender"),
        F.initcap("c_mktsegment").alias("occupation"),
        F.when(F.col("c_acctbal") >= 0, F.round(F.col("c_acctbal") / 100).cast("int").cast("string"))
        .alias("age"),
    )


def title_queries(t: Tables) -> DataFrame:
    """Title queries, one per distinct part name: query."""
    return t.table("part").select(F.col("p_name").alias("query")).distinct()
