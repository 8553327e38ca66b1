"""Title search and title-based recommendations.

Relevance is BM25 in the form modern Lucene uses (no ``k1 + 1`` factor):

    idf(t)      = ln(1 + (N - n_t + 0.5) / (n_t + 0.5))
    w(t, d)     = idf(t) * tf / (tf + k1 * (1 - b + b * dl / avgdl))
    score(q, d) = sum over query tokens t (with repeats) of w(t, d)

N counts items with at least one token, n_t the items holding ``t``, dl the
item's token count. Scores are rounded to 6 places; ties go to the lower id.

Batch design: a whole table of queries is answered in one job. Items whose
titles have the same token multiset score identically for every query, so the
index is built over those multisets ("title shapes"), each keeping its ``k``
smallest ids, and the query side is de-duplicated by text. Candidates come
from an equi-join of query tokens with postings on the token, pruned exactly
(see :func:`title_search`), then a grouped sum scores them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.functions.text import BM25_B, BM25_K1, tokens
from reelrank.session import cut_lineage

SCORE_DIGITS = 6
#: Postings of rare tokens that a query reads before its floor is known: so many, or this share of them if that
#: is more. What they leave is read as far as the floor lets it.
OPEN_POSTINGS, OPEN_SHARE = 200, 1 / 8
#: Room for rounded scores.
_SLACK = 1e-5


def title_shapes(items: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(shape_items, postings).

    shape_items: shape, movieId, title, pos (the k smallest ids per shape).
    postings: shape, token, tf, dl, n_items (items of that shape), min_id."""
    toks = items.select("movieId", "title", tokens("title").alias("toks")).filter(F.size("toks") > 0)
    shaped = toks.select("movieId", "title", F.array_join(F.array_sort("toks"), " ").alias("shape"))
    w = Window.partitionBy("shape").orderBy("movieId")
    shape_items = shaped.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)
    counts = shaped.groupBy("shape").agg(F.count("*").alias("n_items"), F.min("movieId").alias("min_id"))
    # Tokens never contain a blank, so the shape splits back into its tokens.
    postings = (
        counts.select("shape", "n_items", "min_id", F.split("shape", " ").alias("toks"))
        .select("shape", "n_items", "min_id", F.size("toks").alias("dl"), F.explode("toks").alias("token"))
        .groupBy("shape", "token", "dl", "n_items", "min_id").agg(F.count("*").alias("tf"))
    )
    return shape_items.select("shape", "movieId", "title", "pos"), postings


def term_weights(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(weights, doc_freq): ``shape, token, tf, dl, min_id, w`` (the BM25 weight
    of one token in one title shape) and ``token, n_t`` (items holding it)."""
    shapes = postings.select("shape", "dl", "n_items").dropDuplicates(["shape"])
    stats = shapes.agg(
        F.sum("n_items").alias("n_docs"),
        (F.sum(F.col("dl") * F.col("n_items")) / F.sum("n_items")).alias("avgdl"),
    )
    df_t = postings.groupBy("token").agg(F.sum("n_items").alias("n_t"))
    # ``stats`` is a single row: attaching it is a broadcast of one row.
    idf = df_t.crossJoin(F.broadcast(stats)).select(
        "token", "avgdl",
        F.log(F.lit(1.0) + (F.col("n_docs") - F.col("n_t") + 0.5) / (F.col("n_t") + 0.5)).alias("idf"),
    )
    norm = F.lit(BM25_K1) * (F.lit(1.0 - BM25_B) + F.lit(BM25_B) * F.col("dl") / F.col("avgdl"))
    weights = postings.join(idf, "token").select(
        "shape", "token", "tf", "dl", "min_id", (F.col("idf") * F.col("tf") / (F.col("tf") + norm)).alias("w"))
    return weights, df_t


def title_candidates(postings: DataFrame, weights: DataFrame, doc_freq: DataFrame,
                     queries: DataFrame, k: int, query_col: str = "query") -> tuple[DataFrame, DataFrame]:
    """(candidates, query tokens): the (query, shape) pairs that can reach a
    query's top ``k`` (see :func:`title_search`), and (query, token, qtf)."""
    # Same (tf, dl) means the same weight for a token. The postings are still
    # partitioned by shape here, so Spark limits every class to k rows
    # map-side before the shuffle: a token in a third of all titles is cut
    # in every task instead of landing in one.
    by_class = Window.partitionBy("token", "tf", "dl").orderBy("min_id")
    heads = (
        postings.withColumn("_h", F.row_number().over(by_class))
        .filter(F.col("_h") <= k).select("token", "shape")
    )
    # Repeated query texts collapse: a token's count is its distinct positions.
    qtok = (
        queries.select(query_col, F.posexplode(tokens(query_col)).alias("_p", "token"))
        .groupBy(query_col, "token").agg(F.countDistinct("_p").alias("qtf"))
    )
    qtok = cut_lineage(qtok)  # read by all kinds of candidates and by the scoring
    blocks = cut_lineage(_query_blocks(qtok, weights, doc_freq, query_col))
    lists = weights.select("token", "dl", "shape", "w")

    by_query = Window.partitionBy(query_col)
    opened = blocks.filter((F.col("_tokens") > 1) & (F.col("_c") == F.col("_tokens"))).withColumn(
        "_read", F.sum("n").over(by_query.orderBy(F.desc("_total"), "dl"))
    ).withColumn("_most", F.greatest(F.lit(OPEN_POSTINGS), F.sum("n").over(by_query) * OPEN_SHARE)
                 ).filter("_read <= _most")
    first = (
        qtok.join(heads, "token").select(query_col, "shape")
        .unionByName(opened.join(lists, ["token", "dl"]).select(query_col, "shape")).distinct()
    )
    first = shape_scores(first, qtok, weights, query_col)
    best = Window.partitionBy(query_col).orderBy(F.desc("score"))
    floors = first.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") == k).select(
        query_col, (F.col("score") - _SLACK).alias("_floor"))

    bounded = blocks.join(floors, query_col, "left").withColumn("_floor", F.coalesce("_floor", F.lit(0.0)))
    left_out = (F.col("_c") == 1) | (F.col("_sum") < F.col("_floor"))
    rest = F.sum(F.when(left_out, F.col("top")).otherwise(0.0)).over(Window.partitionBy(query_col, "dl"))
    read = bounded.withColumn("_rest", rest).filter(~left_out & (F.col("_total") >= F.col("_floor")))
    hits = (
        read.join(lists, ["token", "dl"])
        .groupBy(query_col, "shape")
        .agg(F.sum(F.col("qtf") * F.col("w")).alias("_part"), F.first("_rest").alias("_rest"),
             F.first("_floor").alias("_floor"))
        .filter(F.col("_part") + F.col("_rest") >= F.col("_floor")).select(query_col, "shape")
    )
    strong = first.join(floors, query_col, "left").filter(
        F.col("score") >= F.coalesce("_floor", F.lit(0.0))).select(query_col, "shape")
    return hits.unionByName(strong).distinct(), qtok


def _query_blocks(qtok: DataFrame, weights: DataFrame, doc_freq: DataFrame, query_col: str) -> DataFrame:
    """A row for each query, token and title length ``dl``: ``n`` postings, ``top``
    (the most the token adds to a title of that length), its place ``_c`` among the
    query's ``_tokens`` tokens there, commonest first, ``_sum`` of the tops up to
    that place and ``_total`` of the ``dl`` greatest (a title of ``dl`` words holds no more)."""
    greatest = weights.groupBy("token", "dl").agg(F.max("w").alias("m"), F.count("*").alias("n"))
    rows = qtok.join(doc_freq, "token").join(greatest, "token").select(
        query_col, "token", "qtf", "n_t", "dl", "n", (F.col("qtf") * F.col("m")).alias("top"))
    length = Window.partitionBy(query_col, "dl")
    commonest = length.orderBy(F.col("n_t").desc(), F.col("token").asc())
    greatest_first = length.orderBy(F.col("top").desc(), F.col("token").asc())
    rows = rows.withColumn("_g", F.row_number().over(greatest_first))
    return rows.select(
        "*", F.row_number().over(commonest).alias("_c"),
        F.sum("top").over(commonest.rowsBetween(Window.unboundedPreceding, 0)).alias("_sum"),
        F.sum(F.when(F.col("_g") <= F.col("dl"), F.col("top"))).over(length).alias("_total"),
        F.count("*").over(length).alias("_tokens")).drop("_g")


def shape_scores(cand: DataFrame, qtok: DataFrame, weights: DataFrame, query_col: str = "query") -> DataFrame:
    """(query, shape) -> the same with the exact rounded ``score``."""
    return (
        cand.join(qtok, query_col)
        .join(weights.select("shape", "token", "w"), ["shape", "token"], "left")
        .groupBy(query_col, "shape")
        .agg(F.round(F.sum(F.col("qtf") * F.coalesce(F.col("w"), F.lit(0.0))), SCORE_DIGITS).alias("score"))
    )


def title_search(items: DataFrame, queries: DataFrame, k: int = 10,
                 query_col: str = "query") -> DataFrame:
    """The ``k`` best items per query text: query, rank, movieId, title,
    score. A query that matches nothing gives no rows.

    Exact candidate pruning, no cap. Postings lie in blocks of one token and one
    title length with the block's greatest weight, which is its bound.

    - A shape holding one query token ``t`` only scores ``qtf * w(t, shape)``,
      and ``w`` depends only on (tf, dl). If ``k`` shapes with the same (tf, dl)
      for ``t`` have smaller ids, each of them scores at least as much (weights
      are positive) and wins ties on id. The ``k`` smallest ids per (token, tf,
      dl) class, shared by all queries, therefore suffice.
    - Those heads and some blocks of the query's rarest tokens (see
      ``OPEN_POSTINGS``) are scored first. Their ``k``-th score is the
      query's floor: what scores less is out.
    - Lengths whose bounds add up to less than the floor are not read. Of
      the others the commonest tokens whose bounds together stay below the
      floor are not read either (always at least the commonest): a shape
      holding none but these cannot reach the floor, or holds one token only.
    - A shape met in the lists read goes on if its sum there and the bounds of
      the tokens not read reach the floor.

    What is left is scored exactly over all query tokens."""
    shape_items, postings = title_shapes(items, k)
    # The index is read in every branch below: written once to the shared folder.
    postings = cut_lineage(postings)
    weights, doc_freq = term_weights(postings)
    weights = cut_lineage(weights)
    cand, qtok = title_candidates(postings, weights, doc_freq, queries, k, query_col)
    firsts = weights.select("shape", "min_id").dropDuplicates(["shape"])
    per_shape = shape_scores(cand, qtok, weights, query_col)
    best_shapes = per_shape.join(firsts, "shape").withColumn(
        "_r", F.row_number().over(
            Window.partitionBy(query_col).orderBy(F.col("score").desc(), F.col("min_id").asc()))
    ).filter(F.col("_r") <= k)
    cand_items = best_shapes.join(shape_items, "shape")
    order = Window.partitionBy(query_col).orderBy(F.col("score").desc(), F.col("movieId").asc())
    ranked = cand_items.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(query_col, F.col("rank").cast("int").alias("rank"), "movieId", "title", "score")


def title_seeds(items: DataFrame, queries: DataFrame, query_col: str = "query") -> DataFrame:
    """(query, seed): the best match of each query text that has one."""
    # One row per query: checkpointed (shared folder) so the search runs once
    # and the rest of the plan does not carry it along.
    return cut_lineage(title_search(items, queries, k=1, query_col=query_col).select(
        query_col, F.col("movieId").alias("seed")))


def seed_recommendations(seeds: DataFrame, items: DataFrame, ratings: DataFrame,
                         stored: DataFrame | Callable[[DataFrame], DataFrame], k: int = 10) -> DataFrame:
    """(seed, rank, movieId, title, n_users) of each distinct ``seed``: see :func:`recommend_by_title`."""
    raters = ratings.select(F.col("movieId").alias("seed"), "userId").join(seeds.select("seed").distinct(), "seed", "left_semi")
    lists_df = stored(raters.select("userId").distinct()) if callable(stored) else stored
    lists = lists_df.select("userId", F.col("movieId").alias("rec"))
    # (user, item) is unique in both inputs, so a row count is a user count.
    counted = raters.join(lists, "userId").groupBy("seed", "rec").agg(F.count("*").alias("n_users"))
    order = Window.partitionBy("seed").orderBy(F.col("n_users").desc(), F.col("rec").asc())
    top = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(items.select(F.col("movieId").alias("rec"), "title"), "rec").select(
        "seed", F.col("rank").cast("int").alias("rank"), F.col("rec").alias("movieId"), "title", "n_users")


def recommend_by_title(items: DataFrame, queries: DataFrame, ratings: DataFrame,
                       stored: DataFrame | Callable[[DataFrame], DataFrame], k: int = 10,
                       query_col: str = "query") -> DataFrame:
    """Best title match -> everyone who rated it -> their stored
    recommendation lists -> the items recommended to most of them.

    ``stored`` holds (userId, movieId) of each user's stored list, or is a
    function that builds those lists for a frame of ``userId`` (then only the
    raters of matched items are ranked, not every user). Returns query, rank,
    movieId, title, n_users (users whose list holds the item); ties by
    movieId. Work is shared by queries with the same best hit. Queries without
    an answer have no rows; :func:`title_answers` gives their reason."""
    seeds = title_seeds(items, queries, query_col)
    return seeds.join(seed_recommendations(seeds, items, ratings, stored, k), "seed").select(
        query_col, "rank", "movieId", "title", "n_users")


def title_answers(items: DataFrame, queries: DataFrame, ratings: DataFrame,
                  stored: DataFrame | Callable[[DataFrame], DataFrame], k: int = 10,
                  query_col: str = "query") -> DataFrame:
    """R4 with an answer to every distinct query text: query, reason, rank,
    movieId, title, n_users. ``reason`` is null on ranked rows; a query without
    them has one row with 'no such title' (nothing matches, also for null and empty
    texts), 'no ratings' (nobody rated the best match) or 'no recommendations'
    (its raters have no lists)."""
    seeds = title_seeds(items, queries, query_col)
    ranked = cut_lineage(seed_recommendations(seeds, items, ratings, stored, k))
    rated = ratings.select(F.col("movieId").alias("seed")).join(seeds.select("seed").distinct(), "seed", "left_semi").distinct()
    told = seeds.join(rated.withColumn("_rated", F.lit(True)), "seed", "left").withColumnRenamed(query_col, "_q")
    asked = queries.select(query_col).distinct()
    # a null text equals no seed's text: it keeps its row with a reason
    every = asked.join(told, F.col(query_col) == F.col("_q"), "left").drop("_q").join(ranked, "seed", "left")
    reason = F.when(F.col("rank").isNotNull(), F.lit(None)).when(F.col("seed").isNull(), "no such title").when(
        F.col("_rated").isNull(), "no ratings").otherwise("no recommendations")
    return every.select(query_col, reason.cast("string").alias("reason"), "rank", "movieId", "title", "n_users")
