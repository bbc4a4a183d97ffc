"""Keyed cell store on Parquet: put, last-write-wins per cell, row-key scan.

A table is a folder of layers, each a Parquet set of cells
``(rowkey, family, qualifier, value)`` with a ``_SUCCESS`` marker:

  ``delta=<n>``  the cells of put batch n, one per cell (already reduced),
  ``base=<n>``   a full snapshot of the table as of batch n (compaction).

A put writes only its own cells, so its cost follows the batch, not the
table. A read takes the newest base and the deltas after it: the base
minus the cells any later delta touches (an anti join; the delta side is
small) plus the newest value of each delta cell. Every ``compact_every``
puts a new base is written, and layers older than the ``keep_bases``
newest bases are then deleted, so storage stays near ``keep_bases`` copies
of the table plus recent deltas. Layers are never rewritten: a reader of
version n is never disturbed, and ``read_cells(table, n)`` gives the
table as of batch n for every n from the oldest kept base on.

Semantics of a put batch, cell by cell: the last put of a cell (by the
caller's order columns, value as final tie-break) replaces the stored
value; cells of the same key that the batch does not put stay as they are.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType

from ratewise.schemas import CELL

CELL_KEY = ["rowkey", "family", "qualifier"]


class KeyedStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        compact_every: int = 8,
        keep_bases: int | None = 2,
    ):
        self.spark = spark
        self.root = root
        self.compact_every = compact_every
        # After a compaction, layers older than the ``keep_bases`` newest
        # bases are deleted (None keeps everything); versions from the
        # oldest kept base on stay readable.
        self.keep_bases = keep_bases

    # -- folders -----------------------------------------------------------
    def _fs_path(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def table_path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def _layers(self, table: str) -> list[tuple[int, str]]:
        """Committed layers as (batch number, kind), oldest first (a listing)."""
        p, fs = self._fs_path(self.table_path(table))
        if not fs.exists(p):
            return []
        jvm = self.spark._jvm
        found = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            kind, _, num = name.partition("=")
            if kind not in ("base", "delta") or not num.isdigit():
                continue
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                found.append((int(num), kind))
        return sorted(found)

    def versions(self, table: str) -> list[int]:
        """Batch numbers that were put (each is a readable version)."""
        return sorted({n for n, kind in self._layers(table) if kind == "delta"})

    def _path(self, table: str, kind: str, n: int) -> str:
        return os.path.join(self.table_path(table), f"{kind}={n}")

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(CELL).parquet(path)

    # -- reads -------------------------------------------------------------
    def read_cells(self, table: str, version: int | None = None) -> DataFrame:
        """All cells as of batch ``version`` (default: the newest)."""
        layers = [(n, k) for n, k in self._layers(table) if version is None or n <= version]
        if not layers:
            return self.spark.createDataFrame([], CELL)
        bases = [n for n, k in layers if k == "base"]
        base_n = bases[-1] if bases else -1
        deltas = [n for n, k in layers if k == "delta" and n > base_n]
        base = self._read(self._path(table, "base", base_n)) if bases else None
        if not deltas:
            return base if base is not None else self.spark.createDataFrame([], CELL)
        stacked = None
        for n in deltas:
            d = self._read(self._path(table, "delta", n)).withColumn("_n", F.lit(n))
            stacked = d if stacked is None else stacked.unionByName(d)
        if len(deltas) == 1:
            newest = stacked.drop("_n")
        else:
            newest = stacked.groupBy(*CELL_KEY).agg(F.max_by("value", "_n").alias("value"))
        if base is None:
            return newest
        kept = base.join(newest.select(*CELL_KEY), CELL_KEY, "left_anti")
        return kept.unionByName(newest)

    def _stacked(self, table: str) -> DataFrame | None:
        """All cells of the newest base and the deltas after it, with their batch number."""
        layers = self._layers(table)
        bases = [n for n, k in layers if k == "base"]
        first = bases[-1] if bases else -1
        out = None
        for n, kind in layers:
            if n == first if kind == "base" else n > first:
                layer = self._read(self._path(table, kind, n)).withColumn("_n", F.lit(n))
                out = layer if out is None else out.unionByName(layer)
        return out

    def read_wide(
        self, table: str, qualifiers: Sequence[str] | Mapping[str, str], family: str = "msg"
    ) -> DataFrame:
        """One row per key with one column per qualifier: strings, or of the types of a mapping.

        Layers are merged and turned to rows in one aggregation by row key: of
        each cell the value of the newest layer, summed map-side first. Numbers
        are aggregated by hashing and not by sorting; a value that does not
        parse is null.
        """
        types = qualifiers if isinstance(qualifiers, Mapping) else dict.fromkeys(qualifiers, "string")
        cells = self._stacked(table)
        if cells is None:
            cells = self.spark.createDataFrame([], CELL).withColumn("_n", F.lit(0))
        cells = cells.where((F.col("family") == family) & F.col("qualifier").isin(list(types)))
        return cells.groupBy("rowkey").agg(
            *[
                F.max_by(F.col("value").try_cast(kind), F.when(F.col("qualifier") == q, F.col("_n"))).alias(q)
                for q, kind in types.items()
            ]
        )

    def keys(self, table: str) -> DataFrame:
        """Row-key scan: keys with at least one non-empty cell.

        Puts replace values by values, so a key of any layer still has one.
        """
        cells = self._stacked(table)
        if cells is None:
            cells = self.spark.createDataFrame([], CELL)
        return cells.where(F.col("value").isNotNull()).select("rowkey").distinct()

    # -- writes ------------------------------------------------------------
    def put(
        self,
        table: str,
        puts: DataFrame,
        order: Sequence[str | Column] = (),
        distinct: bool = False,
    ) -> int:
        """Apply a batch of puts; returns its batch number (the new version).

        ``puts`` has (rowkey, family, qualifier, value) plus the columns in
        ``order``, which must order puts of one cell totally (the value is
        the last tie-break). Null values and null or empty row keys are not
        puts. ``distinct``: no cell is put twice, so nothing has to be brought
        together and the batch is written as it comes, without a shuffle.
        """
        valid = F.col("value").isNotNull() & F.col("rowkey").isNotNull() & (F.col("rowkey") != "")
        latest = puts.where(valid)
        if distinct:
            latest = latest.select(*CELL_KEY, "value")
        else:
            order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
            rank = F.struct(*order_cols, F.col("value"))
            latest = latest.groupBy(*CELL_KEY).agg(F.max_by("value", rank).alias("value"))
        layers = self._layers(table)
        n = (layers[-1][0] + 1) if layers else 0
        # Only committed layers count, so a folder at this number can only be
        # the leftover of a failed attempt: overwrite it.
        latest.write.mode("overwrite").parquet(self._path(table, "delta", n))
        since_base = [m for m, k in layers if k == "delta"]
        bases = [m for m, k in layers if k == "base"]
        if bases:
            since_base = [m for m in since_base if m > bases[-1]]
        if len(since_base) + 1 >= self.compact_every:
            self.compact(table)
        return n

    def compact(self, table: str) -> None:
        """Write the current view as a base at the newest batch number."""
        layers = self._layers(table)
        if not layers:
            return
        n = max(m for m, k in layers if k == "delta")
        if (n, "base") in layers:
            return
        self.read_cells(table).write.mode("overwrite").parquet(self._path(table, "base", n))
        if self.keep_bases:
            self.vacuum(table, self.keep_bases)

    def vacuum(self, table: str, keep_bases: int = 2) -> list[str]:
        """Delete layers that no read from the ``keep_bases`` newest bases on
        needs: older bases and the deltas up to the oldest kept base.

        Versions before that base can no longer be read. Returns the
        deleted folders.
        """
        layers = self._layers(table)
        bases = [n for n, k in layers if k == "base"]
        if not bases or keep_bases < 1:
            return []
        cutoff = bases[-keep_bases] if len(bases) >= keep_bases else bases[0]
        doomed = [
            self._path(table, k, n)
            for n, k in layers
            if (k == "base" and n < cutoff) or (k == "delta" and n <= cutoff)
        ]
        for path in doomed:
            p, fs = self._fs_path(path)
            fs.delete(p, True)
        return doomed

    def put_columns(
        self,
        table: str,
        rows: DataFrame,
        key: str | Column,
        cells: dict[str, str | Column],
        family: str = "msg",
        order: Sequence[str | Column] = (),
        distinct: bool = False,
    ) -> int:
        """Put several cells per row: ``cells`` maps qualifier -> column (``distinct``: see ``put``)."""
        key_col = (F.col(key) if isinstance(key, str) else key).cast("string")
        order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
        named_order = [c.alias(f"_o{i}") for i, c in enumerate(order_cols)]
        pairs = F.array(
            *[
                F.struct(
                    F.lit(qual).alias("qualifier"),
                    (F.col(col) if isinstance(col, str) else col)
                    .cast("string")
                    .alias("value"),
                )
                for qual, col in cells.items()
            ]
        )
        # One scan of ``rows``: each row fans out into its cells.
        stacked = rows.select(
            key_col.alias("rowkey"), *named_order, F.inline(pairs)
        ).withColumn("family", F.lit(family))
        return self.put(table, stacked, [f"_o{i}" for i in range(len(order_cols))], distinct)


#: Cells of a stored rating.
RATING_CELLS = {"userId": "user_id", "movieId": "item_id", "rating": "rating"}


def put_ratings(store: KeyedStore, table: str, ratings: DataFrame, key: Column, order: Sequence[str | Column] = ()) -> int:
    """Put (user_id, item_id, rating) rows as ``userId``, ``movieId``, ``rating`` cells."""
    return store.put_columns(table, ratings, key, dict(RATING_CELLS), order=order)


def put_all_ratings(store: KeyedStore, table: str, ratings: DataFrame) -> int:
    """Put every rating: the row key is the whole observation, equal ones are counted.

    ``ratings`` has (user_id, item_id, rating, ts). A key by time alone keeps
    one rating a moment; here none is lost.
    """
    names = ["user_id", "item_id", "rating", "ts"]
    seen = ratings.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    # Of these types no two values have the same text, so every group has a row key of its own.
    distinct = all(isinstance(ratings.schema[c].dataType, (NumericType, DateType, TimestampNTZType)) for c in names)
    return store.put_columns(table, seen, F.concat_ws("|", *parts), {**RATING_CELLS, "copies": "copies"}, distinct=distinct)


#: Types of the cells of a stored rating.
CELL_TYPES = {"userId": "int", "movieId": "int", "rating": "double"}


def _typed_ok(kinds: Mapping[str, str]) -> Column:
    ok = F.lit(True)
    for q, kind in kinds.items():
        ok = ok & F.col(q).try_cast(kind).isNotNull()
    return ok


def typed_rating_cells(store: KeyedStore, table: str) -> DataFrame:
    """(rowkey, user_id int, item_id int, rating double) from the rating cells of a table.

    A rating with a ``copies`` cell gives so many rows. Rows whose cells are
    missing or do not parse are left out (see ``rating_cell_rejects``).
    """
    wide = store.read_wide(table, {**CELL_TYPES, "copies": "int"})
    copies = F.coalesce("copies", F.lit(1))
    return wide.where(_typed_ok(CELL_TYPES) & (copies > 0)).select(
        "rowkey", F.col("userId").alias("user_id"), F.col("movieId").alias("item_id"), "rating",
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).drop("_copy")


def rating_cell_rejects(store: KeyedStore, table: str) -> DataFrame:
    """(rowkey, userId, movieId, rating) of rows that are no typed rating."""
    return store.read_wide(table, [*RATING_CELLS, "copies"]).where(~_typed_ok(CELL_TYPES)).select("rowkey", *RATING_CELLS)
