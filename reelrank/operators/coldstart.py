"""Cold start: demographic model of genre preferences (M5-M8, R2, K2).

The original trained one multi-output random forest with scikit-learn on the
driver, after collecting every profile. Here one multi-output forest is fitted
on the executors (:mod:`reelrank.operators.forest`): one grouped aggregate over
the profiles, then one task for each tree. Gender and occupation are encoded by
the vocabularies of a fitted encoder, the same for training and prediction.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.functions.genres import GENRES, PROFILE_COLUMNS
from reelrank.operators import forest
from reelrank.operators.profiles import profile_targets
from reelrank.operators.scoring import top_k_by_genre_weights
from reelrank.session import cut_lineage

CATEGORICAL = ["gender", "occupation"]
FEATURES = "features"
# --- fixed values -----------------------------------------------------------
# Forest settings of the original model; all features are tried at every split.
RF_NUM_TREES = 100
RF_SEED = 42
RF_MIN_SPLIT = 5
# --- end of fixed values ----------------------------------------------------
RF_MAX_DEPTH = 30  # the original had no limit
RF_MAX_BINS = 128  # ages beyond as many distinct ones are binned at quantiles
#: Cells of the compiled forest that may be broadcast; beyond, Spark chooses the join.
BROADCAST_CELLS = 1_000_000
#: Distinct rows of predicted scores whose lists may be broadcast.
BROADCAST_LISTS = 20_000
CELL = ["age_bin", "gender_level", "occupation_level"]


@dataclass
class GenreModel:
    """The fitted model: vocabularies, borders between age bins, the trees'
    nodes, and the forest compiled to one prediction for each cell."""

    vocab: dict[str, list[str]]
    cuts: list[float]
    nodes: DataFrame
    cells: DataFrame

    def cell_columns(self) -> dict:
        """Age bin and levels of a frame with age, gender and occupation."""
        return {CELL[0]: forest.bin_of(F.col("age"), self.cuts),
                **{name: forest.level_of(F.col(c), self.vocab[c]) for name, c in zip(CELL[1:], CATEGORICAL)}}

    def sizes(self) -> list[int]:
        """Values of each cell column, the unseen level included."""
        return [len(self.cuts) + 1] + [len(self.vocab[c]) + 1 for c in CATEGORICAL]


def prediction_columns() -> list[str]:
    return [f"pred_{g}" for g in GENRES]


def demographic_encoder() -> Pipeline:
    """M5: age numeric; gender and occupation indexed in alphabetical order.
    ``handleInvalid='keep'`` gives unseen values an extra index that the
    encoder drops, so every known level has its own 0/1 slot and an unseen
    value is all zeros."""
    idx = StringIndexer(
        inputCols=CATEGORICAL, outputCols=[f"{c}_idx" for c in CATEGORICAL],
        stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in CATEGORICAL], outputCols=[f"{c}_vec" for c in CATEGORICAL],
        dropLast=True)
    vec = VectorAssembler(
        inputCols=["age"] + [f"{c}_vec" for c in CATEGORICAL], outputCol=FEATURES, handleInvalid="keep")
    return Pipeline(stages=[idx, ohe, vec])


def vocabulary(encoder: PipelineModel | GenreModel) -> dict[str, list[str]]:
    """Levels seen in training, per categorical column."""
    if isinstance(encoder, GenreModel):
        return encoder.vocab
    indexer = next(s for s in encoder.stages if isinstance(s, StringIndexerModel))
    return dict(zip(CATEGORICAL, indexer.labelsArray))


def onehot_columns(df: DataFrame, vocab: dict[str, Sequence[str]]) -> DataFrame:
    """Explicit 0/1 columns ``<column>_<level>`` for the training levels plus
    ``occupation_unseen`` (M5 as a readable table; Q6)."""
    cols = [F.when(F.col(c) == lv, 1).otherwise(0).alias(f"{c}_{lv}")
            for c in CATEGORICAL for lv in vocab[c]]
    unseen = (~F.col("occupation").isin(list(vocab["occupation"]))).cast("int")
    return df.select("userId", "age", *cols, F.coalesce(unseen, F.lit(1)).alias("occupation_unseen"))


def fit_genre_model(profiles: DataFrame, num_trees: int = RF_NUM_TREES, max_depth: int = RF_MAX_DEPTH,
                    target_fill: str = "zero", min_split: int = RF_MIN_SPLIT, max_bins: int = RF_MAX_BINS,
                    seed: int = RF_SEED) -> GenreModel:
    """M7: one forest for all genres. Targets are the profile averages with null
    as 0 (P6), or, with ``target_fill="drop"``, a genre learns only from the users
    who rated it (one that nobody rated is learned as 0). A node needs
    ``min_split`` users to be split. A null age counts as the lowest."""
    if target_fill not in ("zero", "drop"):
        raise ValueError("target_fill is 'zero' or 'drop'")
    filled = profiles if target_fill == "drop" else profile_targets(profiles)
    # read several times below: written once to the shared folder
    train = cut_lineage(filled.select("userId", "age", *CATEGORICAL, *[F.col(c).cast("double").alias(c) for c in PROFILE_COLUMNS]))
    indexer = StringIndexer(inputCols=CATEGORICAL, outputCols=[f"{c}_idx" for c in CATEGORICAL],
                            stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    model = GenreModel(dict(zip(CATEGORICAL, map(list, indexer.labelsArray))), forest.borders(train, "age", max_bins),
                       train, train)
    rows = train.select("userId", *[c.alias(n) for n, c in model.cell_columns().items()], *PROFILE_COLUMNS)
    model.nodes = forest.fit(rows, "userId", CELL, [n - 1 for n in model.sizes()[1:]], PROFILE_COLUMNS,
                             num_trees, max_depth, min_split, seed)
    model.cells = cut_lineage(forest.compiled(model.nodes, CELL, model.sizes(), prediction_columns()))
    return model


def save_model(model: GenreModel, path: str) -> str:
    """K2: persist vocabularies, borders, trees and the compiled forest to shared storage."""
    spark = model.nodes.sparkSession
    head = spark.createDataFrame([(model.vocab["gender"], model.vocab["occupation"], model.cuts)],
                                 "gender array<string>, occupation array<string>, cuts array<double>")
    for name, df in (("nodes", model.nodes), ("cells", model.cells), ("head", head)):  # the head last: it tells a whole model
        df.write.mode("overwrite").parquet(os.path.join(path, name))
    return path


def load_model(path: str) -> GenreModel:
    spark = SparkSession.getActiveSession()
    head = spark.read.parquet(os.path.join(path, "head")).first()
    nodes, cells = (spark.read.parquet(os.path.join(path, name)) for name in ("nodes", "cells"))
    return GenreModel({"gender": list(head["gender"]), "occupation": list(head["occupation"])}, list(head["cuts"]), nodes, cells)


def predict_genre_scores(model: GenreModel, requests: DataFrame, id_col: str = "requestId") -> DataFrame:
    """M8: the 18 predicted genre scores per request (wide), plus
    ``occupation_unseen``. ``requests`` needs age, gender, occupation. A request
    is joined to its cell of the compiled forest; unseen levels have cells too."""
    asked = requests.select(id_col, "age", *CATEGORICAL).withColumns(model.cell_columns())
    sizes = model.sizes()
    cells = F.broadcast(model.cells) if sizes[0] * sizes[1] * sizes[2] <= BROADCAST_CELLS else model.cells
    unseen = (F.col(CELL[2]) == len(model.vocab["occupation"])).cast("int")
    return asked.join(cells, CELL, "left").select(
        id_col, unseen.alias("occupation_unseen"), *prediction_columns(), genre_score_map().alias("genre_scores"))


def genre_score_map():
    """The genre names paired with the predicted scores, as
    ``map<string, double>`` (``map_from_arrays``)."""
    return F.map_from_arrays(F.array(*[F.lit(g) for g in GENRES]),
                             F.array(*[F.col(p) for p in prediction_columns()]))


def genre_scores_long(scores: DataFrame, id_col: str = "requestId") -> DataFrame:
    """M8 long form: id, genre, score."""
    stacked = scores.select(id_col, *[F.col(p).alias(g) for p, g in zip(prediction_columns(), GENRES)])
    return stacked.unpivot([id_col], GENRES, "genre", "score")


def recommend_new(scores: DataFrame, items: DataFrame, k: int = 10, id_col: str = "requestId") -> DataFrame:
    """R2: rank items by predicted genre scores; only scores > 0 count.

    The model predicts one row of scores for each cell, so many requests have
    equal scores: every distinct row is ranked once and its list goes to all its
    requests. Beyond :data:`BROADCAST_LISTS` distinct rows each request is ranked by itself."""
    preds = prediction_columns()
    weights = scores.selectExpr(
        f"`{id_col}`", *[f"CASE WHEN `{p}` > 0 THEN CAST(`{p}` AS DOUBLE) ELSE 0.0D END AS `{p}`" for p in preds])
    # numbered, so written once: a number must be the same wherever it is read
    distinct = cut_lineage(weights.select(*preds).distinct().withColumn("_list", F.monotonically_increasing_id()))
    if distinct.count() > BROADCAST_LISTS:
        return top_k_by_genre_weights(weights, id_col, preds, items, k)
    ranked = top_k_by_genre_weights(distinct, "_list", preds, items, k)
    lists = ranked.groupBy("_list").agg(F.collect_list(F.struct("score", "movieId", "title")).alias("_items"))
    n = int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Both bounded: BROADCAST_LISTS rows of 18 scores, and as many lists of k items.
    answered = weights.repartitionByRange(n, id_col).join(F.broadcast(distinct), preds).select(id_col, "_list")
    answered = answered.join(F.broadcast(lists), "_list").select(id_col, F.inline("_items"))
    # an id that comes twice has one list, the best of both
    order = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("movieId").asc())
    return answered.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        id_col, "rank", "movieId", "title", "score")
