"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import scratch_path
from ratewise.session import ship_package as _ship_package

#: Rows up to which a table of ids or short keys is sent to every task.
BROADCAST_ROWS = 200_000


#: Rows of one Arrow batch: whole texts make ten thousand of them too many bytes at once.
BATCH_ROWS = 500
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in tasks, and keep Arrow batches of texts small."""
    _ship_package(spark)
    if int(spark.conf.get(_BATCH_CONF, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back.

    This cuts the lineage and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when an exact count is within ``rows``.

    A larger table is returned as it is, and joins shuffle it.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: What an operator remembers from task to task in a Python worker, and how to drop it.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembers(owner: str, drop: Callable[[], None]) -> None:
    """Say how to drop what ``owner`` keeps in this worker between its tasks."""
    _REMEMBERED[owner] = drop


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = ""):
    """A task function that gives its memory back to the system when it ends.

    Python workers are reused: what one stage freed but kept would stay in the
    executor's memory during all later stages. What other operators than
    ``owner`` remember in the worker is dropped before the task begins.
    """
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other, drop in _REMEMBERED.items():
            if other != owner:
                drop()
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return task


def hash_mod(col: str, m: int):
    """crc32 of the id as decimal text, modulo ``m``."""
    return F.crc32(F.col(col).cast("string")) % F.lit(m)


def free_name(base: str, taken: Sequence[str]) -> str:
    """A column name that no column of ``taken`` has, whatever its case."""
    low = {t.lower() for t in taken}
    while base.lower() in low:
        base = "_" + base
    return base


__all__ = ["BROADCAST_ROWS", "remembers", "table", "written", "small", "lean", "hash_mod", "free_name",
           "scratch_path", "ship_package"]
