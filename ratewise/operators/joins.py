"""Joins that choose between a broadcast and a shuffle by an exact size.

A table is broadcast only when its size, computed from its exact row count
(factor tables: rows * (8 * rank + 48) bytes), is within
``ratewise.broadcast.maxBytes`` (default 256 MiB); optimizer estimates are not
used for this decision. Beyond the bound the join is a sort-merge join, which
adaptive execution splits where a key is hot, or the callers switch to a plan
of blocks (blocked half step, top-N grid).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT_CONF = "ratewise.broadcast.maxBytes"
DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_LIMIT_CONF, str(DEFAULT_BROADCAST_LIMIT)))


def factor_bytes(n_rows: int, rank: int) -> int:
    return int(n_rows) * (8 * rank + 48)


def fits_broadcast(spark: SparkSession, n_rows: int, rank: int) -> bool:
    return factor_bytes(n_rows, rank) <= broadcast_limit(spark)


def sized(df: DataFrame, row_bytes: int, n_rows: int | None = None) -> DataFrame:
    """``df`` as a join side: broadcast within the bound, else sort-merge."""
    n_rows = df.count() if n_rows is None else n_rows
    small = n_rows * row_bytes <= broadcast_limit(df.sparkSession)
    return F.broadcast(df) if small else df.hint("merge")


def lookup(
    df: DataFrame,
    factors: DataFrame,
    key: str,
    alias: str,
    rank: int,
    how: str = "inner",
    n_rows: int | None = None,
) -> DataFrame:
    """``df`` joined on ``key`` with the factor table's vectors as ``alias``."""
    f = factors.select(F.col("id").alias(key), F.col("features").alias(alias))
    return df.join(sized(f, factor_bytes(1, rank), n_rows), key, how)


def only_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the distinct ``ids``."""
    return df.join(sized(ids, factor_bytes(1, 0)), key, "left_semi")
