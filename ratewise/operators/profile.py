"""Counts, entity lists, the train/test split and the NaN guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_train_test(
    ratings: DataFrame, test_modulus: int = 10, cold_user_modulus: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Deterministic split on the integer keys.

    A rating is held out when ``(user_id*31 + item_id*17) mod test_modulus``
    is 0; every rating of a user with ``user_id mod cold_user_modulus = 0``
    is held out too, so the test set has users the model never saw.
    Nothing is dropped: train and test together are all the rows.
    """
    is_test = split_flag(F.col("user_id"), F.col("item_id"), test_modulus, cold_user_modulus)
    return ratings.where(~is_test), ratings.where(is_test)


def split_flag(user: Column, item: Column, test_modulus: int, cold_user_modulus: int) -> Column:
    mixed = user.cast("long") * F.lit(31) + item.cast("long") * F.lit(17)
    return (F.pmod(mixed, F.lit(test_modulus)) == 0) | (
        F.pmod(user.cast("long"), F.lit(cold_user_modulus)) == 0
    )


def tag_split(
    ratings: DataFrame, test_modulus: int = 10, cold_user_modulus: int = 50, flag: str = "is_test"
) -> DataFrame:
    """``ratings`` with the split of ``split_train_test`` as a column, so that
    one pass can serve both sides."""
    is_test = split_flag(F.col("user_id"), F.col("item_id"), test_modulus, cold_user_modulus)
    return ratings.withColumn(flag, F.coalesce(is_test, F.lit(False)))


def rating_profile(tagged: DataFrame) -> DataFrame:
    """Train rows, test rows, users and items with train ratings (one row).

    ``tagged`` has (user_id, item_id, is_test): one scan, one aggregation.
    """
    is_train = ~F.col("is_test")
    return tagged.agg(
        F.count(F.when(is_train, 1)).cast("long").alias("n_train"),
        F.count(F.when(~is_train, 1)).cast("long").alias("n_test"),
        F.countDistinct(F.when(is_train, F.col("user_id"))).cast("long").alias("n_users"),
        F.countDistinct(F.when(is_train, F.col("item_id"))).cast("long").alias("n_items"),
    )


def entity_lists(train: DataFrame) -> DataFrame:
    """Distinct users and items of the train set: (entity, id)."""
    both = F.array(
        F.struct(F.lit("user").alias("entity"), F.col("user_id").alias("id")),
        F.struct(F.lit("item").alias("entity"), F.col("item_id").alias("id")),
    )
    return train.select(F.inline(both)).distinct()


def nan_guard(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job if any listed numeric or vector column holds a NaN."""
    checks = []
    for c in columns:
        dtype = df.schema[c].dataType.simpleString()
        if dtype.startswith("array"):
            bad = F.exists(F.col(c), lambda x: F.isnan(x))
        else:
            bad = F.isnan(F.col(c))
        checks.append(F.coalesce(bad, F.lit(False)))
    any_bad = checks[0]
    for c in checks[1:]:
        any_bad = any_bad | c
    guard = F.assert_true(~any_bad, F.lit("NaN in normal equations"))
    # As a filter the optimizer has to keep it, whatever columns are read later.
    return df.where(guard.isNull())
