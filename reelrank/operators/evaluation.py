"""Prediction quality: RMSE as a lazy aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.items import item_avg_rating

RMSE_DIGITS = 6


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: metric, value, n. Rows with a null prediction are ignored
    (the cold-start 'drop' rule). Same value as ``RegressionEvaluator``."""
    valid = predictions.filter(F.col(prediction).isNotNull() & ~F.isnan(prediction))
    err = (F.col(prediction).cast("double") - F.col(label).cast("double"))
    return valid.agg(
        F.round(F.sqrt(F.avg(err * err)), RMSE_DIGITS).alias("value"),
        F.count("*").alias("n"),
    ).select(F.lit("rmse").alias("metric"), "value", "n")


def item_mean_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Baseline predictor: an item's average training rating. Test items
    unseen in training get no prediction and are dropped."""
    means = item_avg_rating(train).select("movieId", F.col("avg_rating").alias("prediction"))
    return test.join(means, "movieId", "inner")


def rmse_item_mean(split: DataFrame) -> DataFrame:
    """A6 on a labelled split (column ``split`` = 'train' / 'test')."""
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    return rmse(item_mean_predictions(train, test))
