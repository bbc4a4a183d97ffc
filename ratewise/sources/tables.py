"""Driver tables and the rating inputs derived from them.

``ratings_b`` (batch history) comes from lineitem joined to orders,
``ratings_s`` (stream) from events; items from part, users from customer.
Only the columns each input needs are read, so the Parquet scans prune.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rating_from_quantity(qty: Column) -> Column:
    """Quantities 1..50 map to ratings 1..5 in steps of ten."""
    return (F.lit(1) + F.floor((qty - F.lit(1)) / F.lit(10))).cast("double")


def rating_from_value(value: Column) -> Column:
    """Event values map to ratings 1..5, capped at 5."""
    return F.least(F.lit(5), F.lit(1) + F.floor(value / F.lit(20))).cast("double")


def ratings_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch rating history: (user_id, item_id, rating, ts)."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        rating_from_quantity(F.col("l_quantity")).alias("rating"),
        F.col("l_shipdate").alias("ts"),
    )


def ratings_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed ratings: (user_id, item_id, rating, ts, event_id)."""
    ev = load_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "value", "props"
    )
    return ev.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        rating_from_value(F.col("value")).alias("rating"),
        F.col("ts"),
        F.col("event_id"),
    )


def items_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item (movie) table with price: (item_id, name, price)."""
    return load_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )


def users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known users: (user_id)."""
    return load_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id")
    )
