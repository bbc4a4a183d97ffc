"""Known-pair filters, predictions and RMSE with the cold-start rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.vectors import dot
from ratewise.operators.als_exact import evaluate_epoch, rmse_frame
from ratewise.operators.joins import lookup

__all__ = ["evaluate_epoch", "known_pairs", "predict_pairs", "rmse", "rmse_frame"]


def known_pairs(
    spark: SparkSession,
    ratings: DataFrame,
    user_f: DataFrame,
    item_f: DataFrame,
    rank: int,
    which: str = "both",
) -> DataFrame:
    """Ratings whose user / item / both have factors (semi joins)."""
    out = ratings
    if which in ("user", "both"):
        out = lookup(out, user_f, "user_id", "_u", rank, "left_semi")
    if which in ("item", "both"):
        out = lookup(out, item_f, "item_id", "_v", rank, "left_semi")
    return out


def predict_pairs(
    spark: SparkSession, ratings: DataFrame, user_f: DataFrame, item_f: DataFrame, rank: int
) -> DataFrame:
    """(user_id, item_id, rating, prediction) for pairs with both factors."""
    j = lookup(ratings.select("user_id", "item_id", "rating"), user_f, "user_id", "u", rank)
    j = lookup(j, item_f, "item_id", "v", rank)
    return j.select(
        "user_id", "item_id", "rating", dot(F.col("u"), F.col("v"), rank).alias("prediction")
    )


def rmse(ratings: DataFrame, user_f: DataFrame, item_f: DataFrame, rank: int) -> DataFrame:
    """One row: n_all, n_known, sse, rmse = sqrt(SSE over known / all rows).

    A pair whose user or item has no factor adds no error but counts.
    """
    parts = rmse_frame(ratings, user_f, item_f, rank, "all")
    return parts.agg(
        F.count(F.lit(1)).cast("long").alias("n_all"),
        F.count(F.when(F.col("known"), 1)).cast("long").alias("n_known"),
        F.sum("sq").alias("sse"),
    ).select(
        "n_all", "n_known", "sse", F.sqrt(F.try_divide(F.col("sse"), F.col("n_all"))).alias("rmse")
    )
