"""Blocked half step: ratings stay put, fixed-side vectors travel once per block.

Set-up, once per side (solve key S, fixed key X):
  * equal ratings are one row with a weight (``als_exact.weighted``),
  * every S key goes to a block ``pmod(xxhash64(S, salt), B)``; a key with
    more than ``hot_rows`` different ratings is split into ceil(n / hot_rows)
    salts of (X, rating), so no block holds a hot key whole,
  * ratings are hash-partitioned on the block, sorted by (block, S) and
    persisted; they are never shuffled again,
  * ``need`` lists the distinct (X, block) pairs: which blocks use which
    fixed vectors.

Each half step:
  * fixed factors join ``need`` (broadcast when provably small, else a
    shuffle join whose skew is bounded: at most B rows per X key) and are
    shuffled to their blocks, one copy per (X, block), not per rating,
  * a co-grouped pandas step per block looks vectors up by X, sums
    ``q q^T`` and ``rating * q`` over each run of one S key with numpy,
    and solves keys that are whole in the block; split keys emit partial
    sums that Spark ML's ``Summarizer`` merges per key before their solve.

Groups are blocks of bounded size (B follows the row count), never one
entity's ratings gathered by key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.joins import factor_bytes, sized

BLOCK_ROWS = 1_000_000
PARTITION_ROWS = 16_000_000
OUT_SCHEMA = "id int, n long, features array<double>, sse double, v array<double>"


@dataclass
class BlockedSide:
    solve_key: str
    fixed_key: str
    ratings: DataFrame
    need: DataFrame
    blocks: int
    partitions: int
    has_split: bool = True
    hot: DataFrame | None = None

    def unpersist(self) -> None:
        if self.hot is not None:
            self.hot.unpersist()
        self.ratings.unpersist()
        self.need.unpersist()


def blocked_side(
    ratings: DataFrame,
    solve_key: str,
    fixed_key: str,
    n_rows: int,
    blocks: int | None = None,
    block_rows: int = BLOCK_ROWS,
    hot_rows: int | None = None,
    min_blocks: int = 1,
    partition_rows: int = PARTITION_ROWS,
) -> BlockedSide:
    """Partition ratings once by block of ``solve_key`` (see module doc).

    Blocks hold about ``block_rows`` ratings (one pandas group each);
    partitions hold about ``partition_rows`` ratings, so several blocks, and
    the task count stays moderate at any size.
    """
    b = blocks or max(min_blocks, math.ceil(n_rows / block_rows))
    parts = max(min(b, min_blocks), min(b, math.ceil(n_rows / partition_rows)))
    hot_rows = hot_rows or max(1, block_rows // 4)
    counts = ratings.groupBy(solve_key).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > hot_rows).select(
        solve_key, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("_n_salt")
    )
    # At most n_rows / hot_rows keys are hot; their count is exact all the same.
    hot = hot.persist(StorageLevel.MEMORY_AND_DISK)
    n_hot = hot.count()
    weight = F.col("weight") if "weight" in ratings.columns else F.lit(1.0)
    tagged = ratings.select(solve_key, fixed_key, "rating", weight.alias("weight"))
    tagged = tagged.join(sized(hot, 64, n_hot), solve_key, "left") if n_hot else tagged.withColumn("_n_salt", F.lit(None).cast("int"))
    salt = F.when(
        F.col("_n_salt").isNotNull(),
        F.pmod(F.xxhash64(fixed_key, "rating"), F.col("_n_salt")),
    ).otherwise(F.lit(0))
    tagged = tagged.select(
        F.pmod(F.xxhash64(solve_key, salt), F.lit(b)).cast("int").alias("_blk"),
        solve_key,
        fixed_key,
        "rating",
        "weight",
        F.col("_n_salt").isNotNull().alias("_split"),
    )
    # The cache must keep its hash partitioning on the block, so that every
    # half step's co-group reuses it instead of shuffling the ratings again.
    # A cached adaptive plan reports no partitioning, so this one cached
    # plan is built with adaptive execution off (queries on it keep it on).
    spark = ratings.sparkSession
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        parted = (
            tagged.repartition(parts, "_blk")
            .sortWithinPartitions("_blk", solve_key)
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    # Own column names: ``need`` descends from ``parted`` and is co-grouped
    # with it later, so its columns must not share ids with it.
    need = (
        parted.select(F.col(fixed_key).alias("_x"), F.col("_blk").alias("_nblk"))
        .distinct()
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    # Without hot keys every entity is solved whole inside its block, and
    # the merge of partial sums can be left out of the plan.
    return BlockedSide(solve_key, fixed_key, parted, need, b, parts, n_hot > 0, hot)


def _block_fn(side: BlockedSide, rank: int, lam: float, reg: str, guard: bool, chunk: int):
    s_key, x_key = side.solve_key, side.fixed_key
    iu = np.triu_indices(rank)
    t = len(iu[0])
    diag = np.arange(rank)

    def run(r: pd.DataFrame, vecs: pd.DataFrame) -> pd.DataFrame:
        if len(r) == 0 or len(vecs) == 0:
            return pd.DataFrame({"id": [], "n": [], "features": [], "sse": [], "v": []})
        vx = vecs[x_key].to_numpy()
        order = np.argsort(vx)
        vx = vx[order]
        # Plain columns: an array a row would be an object a row.
        mat = np.stack([vecs[f"f{k}"].to_numpy() for k in range(rank)], axis=1)[order]
        pos = np.searchsorted(vx, r[x_key].to_numpy())
        found = (pos < len(vx)) & (vx[np.minimum(pos, len(vx) - 1)] == r[x_key].to_numpy())
        r = r[found]
        pos = pos[found]
        if len(r) == 0:
            return pd.DataFrame({"id": [], "n": [], "features": [], "sse": [], "v": []})
        keys = r[s_key].to_numpy()
        srt = np.argsort(keys, kind="stable")
        keys, pos = keys[srt], pos[srt]
        rat = r["rating"].to_numpy(dtype=float)[srt]
        weight = r["weight"].to_numpy(dtype=float)[srt]
        split = r["_split"].to_numpy()[srt]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        sums = np.zeros((len(starts), 2 + t + rank))
        # Chunks of whole key runs keep the row-wise products small.
        g0 = 0
        while g0 < len(starts):
            g1 = max(g0 + 1, int(np.searchsorted(ends, starts[g0] + chunk, side="right")))
            lo, hi = starts[g0], ends[g1 - 1]
            q = mat[pos[lo:hi]]
            wq = q * weight[lo:hi, None]
            rel = starts[g0:g1] - lo
            sums[g0:g1, 0] = np.add.reduceat(weight[lo:hi], rel)
            sums[g0:g1, 1 : 1 + t] = np.add.reduceat(wq[:, iu[0]] * q[:, iu[1]], rel, axis=0)
            sums[g0:g1, 1 + t : 1 + t + rank] = np.add.reduceat(wq * rat[lo:hi, None], rel, axis=0)
            sums[g0:g1, -1] = np.add.reduceat(weight[lo:hi] * rat[lo:hi] ** 2, rel)
            g0 = g1
        if guard and np.isnan(sums).any():
            raise ValueError(f"NaN in normal equations of {s_key}")
        ids = keys[starts].astype("int32")
        is_split = split[starts]
        whole = ~is_split
        sse = np.full(len(starts), np.nan)
        if not is_split.any():
            x, sse = solve_rows(sums, rank, lam, reg, iu, diag)
            feats = list(x)
            vs = [None] * len(starts)
        else:
            feats = [None] * len(starts)
            if whole.any():
                x, e = solve_rows(sums[whole], rank, lam, reg, iu, diag)
                sse[whole] = e
                for j, k in enumerate(np.flatnonzero(whole)):
                    feats[k] = x[j]
            vs = [sums[k] if is_split[k] else None for k in range(len(starts))]
        return pd.DataFrame(
            {"id": ids, "n": sums[:, 0].astype("int64"), "features": feats, "sse": sse, "v": vs}
        )

    return run


def solve_rows(sums: np.ndarray, rank: int, lam: float, reg: str, iu=None, diag=None):
    """Solve (A + lam_e I) x = b for rows of [n, triangle(A), b, sum r^2].

    Returns (x, sse) where sse is the entity's own squared error under x.
    """
    from ratewise.operators.als_exact import fit_sse

    iu = iu if iu is not None else np.triu_indices(rank)
    diag = diag if diag is not None else np.arange(rank)
    t = len(iu[0])
    m = len(sums)
    a = np.zeros((m, rank, rank))
    a[:, iu[0], iu[1]] = sums[:, 1 : 1 + t]
    a[:, iu[1], iu[0]] = sums[:, 1 : 1 + t]
    plain = a.copy()
    shift = lam * sums[:, 0] if reg == "count" else np.full(m, lam)
    a[:, diag, diag] += shift[:, None]
    b = sums[:, 1 + t : 1 + t + rank]
    x = np.linalg.solve(a, b[..., None])[..., 0]
    return x, fit_sse(sums[:, -1], b, plain, x)


def _merge_solver(rank: int, lam: float, reg: str):
    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            sums = np.stack(pdf["s"].to_numpy())
            x, sse = solve_rows(sums, rank, lam, reg)
            yield pd.DataFrame(
                {"id": pdf["id"].to_numpy(dtype="int32"), "features": list(x), "sse": sse,
                 "n": sums[:, 0].astype("int64")}
            )

    return run


def blocked_half_step(
    spark: SparkSession,
    side: BlockedSide,
    fixed: DataFrame,
    n_fixed: int,
    rank: int,
    lam: float,
    reg: str = "plain",
    guard: bool = True,
    out_path: str | None = None,
    chunk_cells: int = 8_000_000,
) -> DataFrame:
    """New (id, features) for the solve side; written to ``out_path`` if given."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    x = side.fixed_key
    f = sized(fixed.select(F.col("id").alias(x), F.col("features").alias("f")), factor_bytes(1, rank), n_fixed)
    shipped = (
        side.need.join(f, side.need["_x"] == f[x])
        .select(F.col("_nblk").alias("_blk"), F.col("_x").alias(x), *[F.col("f")[k].alias(f"f{k}") for k in range(rank)])
        .repartition(side.partitions, "_blk")
    )
    t = rank * (rank + 1) // 2
    chunk = max(256, chunk_cells // (t + rank))
    fn = _block_fn(side, rank, float(lam), reg, guard, chunk)
    out = (
        side.ratings.groupBy("_blk")
        .cogroup(shipped.groupBy("_blk"))
        .applyInPandas(fn, OUT_SCHEMA)
    )
    if out_path is not None:
        out.write.mode("error").parquet(out_path)
        out = spark.read.schema(out.schema).parquet(out_path)
    whole = out.where(F.col("features").isNotNull()).select("id", "features", "sse", "n")
    if not side.has_split:
        return whole
    parts = out.where(F.col("v").isNotNull())
    merged = (
        parts.select("id", array_to_vector("v").alias("v"))
        .groupBy("id")
        .agg(Summarizer.sum(F.col("v")).alias("s"))
        .select("id", vector_to_array("s").alias("s"))
        .mapInPandas(_merge_solver(rank, float(lam), reg), "id int, features array<double>, sse double, n long")
    )
    return whole.unionByName(merged)
