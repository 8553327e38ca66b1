"""K4: answer documents, ``{userId, recommendations:[{movieId,title}]}`` per user or
request, ``{movie_title, recommendations:[...]}`` per title query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.sinks.snapshots import publish_snapshot


def answer_documents(ranked: DataFrame, id_col: str = "userId", doc_col: str | None = None,
                     doc_name: str | None = None) -> DataFrame:
    """Group ranked long rows (id, rank, movieId, title, ...) into one JSON
    text per id, recommendations in rank order. The document carries
    ``doc_col`` (default: the id; one value per id) under ``doc_name``. Each
    group holds at most k rows, so ``collect_list`` is bounded by k."""
    doc_col = doc_col or id_col
    grouped = ranked.groupBy(id_col).agg(
        F.first(doc_col).alias("_subject"),
        F.array_sort(F.collect_list(F.struct("rank", "movieId", "title"))).alias("_recs"))
    recs = F.transform("_recs", lambda r: F.struct(r["movieId"].alias("movieId"), r["title"].alias("title")))
    doc = F.struct(F.col("_subject").alias(doc_name or doc_col), recs.alias("recommendations"))
    return grouped.select(id_col, F.to_json(doc, {"ignoreNullFields": "false"}).alias("answer"))


def title_documents(ranked: DataFrame, query_col: str = "query") -> DataFrame:
    """One document per title query, ``{movie_title, recommendations}``."""
    return answer_documents(ranked, query_col, doc_name="movie_title")


def title_answer_documents(answers: DataFrame, query_col: str = "query") -> DataFrame:
    """One document for every title query (rows of ``search.title_answers``):
    ``{movie_title, recommendations}``, or ``{movie_title, reason}`` where there
    is nothing to recommend. A group holds at most k rows."""
    grouped = answers.groupBy(query_col).agg(
        F.max("reason").alias("reason"),
        F.array_sort(F.collect_list(F.struct("rank", "movieId", "title"))).alias("_recs"))
    recs = F.transform("_recs", lambda r: F.struct(r["movieId"].alias("movieId"), r["title"].alias("title")))
    subject = F.col(query_col).alias("movie_title")
    keep = {"ignoreNullFields": "false"}
    return grouped.select(query_col, "reason", F.when(
        F.col("reason").isNull(), F.to_json(F.struct(subject, recs.alias("recommendations")), keep)).otherwise(
        F.to_json(F.struct(subject, F.col("reason")), keep)).alias("answer"))


def bulk_lines(docs: DataFrame, index: str, id_col: str, doc_col: str) -> DataFrame:
    """The two lines that a document store's bulk interface takes for each row:
    an ``index`` action with the row's id, and the document (JSON text of ``doc_col``). Rows
    without an id or a document are left out: the store would make up an id."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_col).cast("string").alias("_id")).alias("index")))
    known = docs.filter(F.col(id_col).isNotNull() & F.col(doc_col).isNotNull())
    return known.select(F.concat_ws("\n", action, doc_col).alias("value"))


def publish_bulk(docs: DataFrame, path: str, index: str, id_col: str, doc_col: str, keep: int = 2) -> str:
    """Bulk files of documents with ids, replaced as a whole: a failing
    partition leaves the version before. Writing the same rows again gives the same ids."""
    return publish_snapshot(bulk_lines(docs, index, id_col, doc_col), path, "text", keep)
