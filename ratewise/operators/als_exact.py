"""Alternating least squares with an exact, testable convention.

Each epoch solves every user given the item factors, then every item given
the new user factors (Gauss-Seidel order):

    x_e = (sum_{r in R(e)} q q^T + lam_e I)^-1  sum_{r in R(e)} rating * q

with ``lam_e = lam`` (``reg="plain"``) or ``lam * |R(e)|`` (``reg="count"``,
the convention of Spark ML's ALS). After both half steps the train and
test RMSE are taken; a test pair whose user or item has no factor adds no
error but counts in the denominator.

Two physical plans for a half step, chosen per side:

* sums (rank <= 12 and the fixed side's factor table within the broadcast
  bound): cached ratings -> broadcast hash join with the fixed vectors ->
  per-entity Catalyst sums of the upper triangle of q q^T, rating * q and
  rating^2 (partial aggregation map-side, so a hot entity never sits whole
  in one task) -> one batched numpy solve per Arrow batch of entities;
* blocks (otherwise): see ``blocks.py``; ratings stay partitioned by block
  and vectors are shipped once per block.

The solve also returns each entity's own squared error (from its sums),
so the train RMSE of an epoch needs no extra pass over the ratings.
Factors are written to the shared folder after every half step, which
cuts the lineage and survives executor loss.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.vectors import dot, init_vector, triangle_index
from ratewise.operators.blocks import BLOCK_ROWS, blocked_half_step, blocked_side
from ratewise.operators.joins import fits_broadcast, lookup
from ratewise.session import scratch_path

FACTOR_SCHEMA = "id int, features array<double>, sse double, n long"


def weighted(ratings: DataFrame) -> DataFrame:
    """Equal observations as one row with a ``weight`` (how often it stands).

    Rows with a null id or rating are no observations. Equal rows are summed
    map-side first, so a key whose ratings are all alike shrinks before it is
    shuffled, and what is left of a hot key differs row by row.
    """
    cols = ["user_id", "item_id", "rating"]
    return ratings.select(*cols).dropna().groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def init_factors(ids: DataFrame, id_col: str, rank: int, seed: int = 0) -> DataFrame:
    """One deterministic uniform [-1, 1) vector per distinct id."""
    return ids.select(F.col(id_col).alias("id")).distinct().select(
        "id", init_vector(F.col("id"), rank, seed).alias("features")
    )


SUMS_MAX_RANK = 12


def normal_equations(joined: DataFrame, key: str, rank: int) -> DataFrame:
    """Per entity: n, upper triangle of sum q q^T, sum rating * q, sum rating^2.

    ``joined`` has ``key``, ``rating``, the fixed side's vector ``f`` and, if
    equal observations were put together, their ``weight``.
    One Catalyst ``sum`` per triangle cell: code-generated, partially
    aggregated map-side, so a hot entity is never gathered whole. Meant for
    small ranks; r(r+1)/2 sums grow the generated code quickly, and above
    rank 12 the blocked half step (``blocks.py``) is used instead.
    """
    f, r = F.col("f"), F.col("rating")
    w = F.col("weight") if "weight" in joined.columns else F.lit(1.0)
    tri = [F.sum(w * f[a] * f[b]) for a, b in triangle_index(rank)]
    rhs = [F.sum(w * f[a] * r) for a in range(rank)]
    return joined.groupBy(key).agg(
        F.sum(w).cast("long").alias("n"),
        F.array(*tri).alias("ata"),
        F.array(*rhs).alias("atb"),
        F.sum(w * r * r).alias("rr"),
    )


def _solver(key: str, rank: int, lam: float, reg: str, guard: bool = True):
    iu = np.triu_indices(rank)
    diag = np.arange(rank)

    def solve(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            m = len(pdf)
            tri = np.stack(pdf["ata"].to_numpy())
            b = np.stack(pdf["atb"].to_numpy())
            if guard and (np.isnan(tri).any() or np.isnan(b).any()):
                bad = pdf[key].to_numpy()[np.isnan(tri).any(axis=1) | np.isnan(b).any(axis=1)]
                raise ValueError(f"NaN in normal equations of {key} {bad[:5].tolist()}")
            a = np.zeros((m, rank, rank))
            a[:, iu[0], iu[1]] = tri
            a[:, iu[1], iu[0]] = tri
            plain = a.copy()
            shift = lam * pdf["n"].to_numpy(dtype=float) if reg == "count" else np.full(m, lam)
            a[:, diag, diag] += shift[:, None]
            x = np.linalg.solve(a, b[..., None])[..., 0]
            sse = fit_sse(pdf["rr"].to_numpy(dtype=float), b, plain, x)
            yield pd.DataFrame(
                {"id": pdf[key].to_numpy(dtype="int32"), "features": list(x), "sse": sse,
                 "n": pdf["n"].to_numpy(dtype="int64")}
            )

    return solve


def fit_sse(rr: np.ndarray, b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared error of an entity's own ratings under its new factor.

    sum (r - q.x)^2 = sum r^2 - 2 x.b + x^T A x, with A = sum q q^T and
    b = sum r q: the train error comes out of the solve with no extra pass
    over the ratings.
    """
    sse = rr - 2.0 * np.einsum("mi,mi->m", x, b) + np.einsum("mi,mij,mj->m", x, a, x)
    # A near-perfect fit can round below zero; the true value cannot be.
    return np.maximum(sse, 0.0)


def solve_factors(
    neq: DataFrame, key: str, rank: int, lam: float, reg: str = "plain", guard: bool = True
) -> DataFrame:
    """Regularised solve per entity, batched over Arrow batches of entities.

    With ``guard`` a NaN in any normal equation fails the task (and so the
    job), checked in the same numpy pass as the solve.
    """
    if reg not in ("plain", "count"):
        raise ValueError(f"reg must be 'plain' or 'count', not {reg!r}")
    return neq.mapInPandas(_solver(key, rank, float(lam), reg, guard), FACTOR_SCHEMA)


def check_factors(
    observed: DataFrame, fixed: DataFrame, solved: DataFrame, fixed_key: str, solve_key: str,
    rank: int, lam: float, reg: str = "plain", tolerance: float = 1e-4,
) -> DataFrame:
    """(id, n, solved): whether each entity's factor solves its normal equations.

    (A + lam_e I) x = b within ``tolerance`` of the size of its terms, where A
    and b come anew from the observations and the other side's factors: a check
    of any fit, whatever its start and its arithmetic. An entity without a
    factor is not solved.
    """
    joined = attach_factors(observed, fixed, fixed_key, rank)
    neq = normal_equations(joined, solve_key, rank)
    x, shift = F.col("x"), F.lit(float(lam)) * (F.col("n") if reg == "count" else F.lit(1.0))
    place = {pair: k for k, pair in enumerate(triangle_index(rank))}
    off, size = [], []
    for a in range(rank):
        terms = [F.col("ata")[place[min(a, b), max(a, b)]] * x[b] for b in range(rank)] + [shift * x[a]]
        b_a = F.col("atb")[a]
        off.append(F.abs(sum(terms[1:], terms[0]) - b_a))
        size.append(F.abs(b_a) + sum((F.abs(t) for t in terms[1:]), F.abs(terms[0])))
    fits = F.greatest(*off) <= F.lit(tolerance) * F.greatest(*size) if rank > 1 else off[0] <= F.lit(tolerance) * size[0]
    return lookup(neq, solved, solve_key, "x", rank, "left").select(
        F.col(solve_key).alias("id"), "n", F.coalesce(fits, F.lit(False)).alias("solved"))


def update_factors(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entities without a solved row keep their old factor."""
    n = new.select("id", F.col("features").alias("_new"))
    return old.join(n, "id", "left").select(
        "id", F.coalesce(F.col("_new"), F.col("features")).alias("features")
    )


def attach_factors(
    ratings: DataFrame, factors: DataFrame, key: str, rank: int, n_rows: int | None = None
) -> DataFrame:
    """The ``key`` side's vector as ``f`` (inner join, broadcast only within the bound)."""
    return lookup(ratings, factors, key, "f", rank, n_rows=n_rows)


def half_step(
    ratings: DataFrame,
    fixed: DataFrame,
    fixed_key: str,
    solve_key: str,
    rank: int,
    lam: float,
    reg: str = "plain",
    guard: bool = True,
    n_fixed: int | None = None,
) -> DataFrame:
    """New factors for ``solve_key`` entities given ``fixed`` factors.

    Lookup (its kind chosen by the exact size of ``fixed``) + Catalyst sums +
    batched solve. ``n_fixed`` saves the count where the caller has it.
    """
    joined = attach_factors(ratings, fixed, fixed_key, rank, n_fixed)
    cols = [c for c in (solve_key, "rating", "weight", "f") if c in joined.columns]
    neq = normal_equations(joined.select(*cols), solve_key, rank)
    return solve_factors(neq, solve_key, rank, lam, reg, guard)


def rmse_frame(
    ratings: DataFrame, user_f: DataFrame, item_f: DataFrame, rank: int, split: str,
    n_users: int | None = None, n_items: int | None = None,
) -> DataFrame:
    """SSE over known pairs, known count and all rows, tagged by split."""
    j = lookup(ratings.select("user_id", "item_id", "rating"), user_f, "user_id", "u", rank, "left", n_users)
    j = lookup(j, item_f, "item_id", "v", rank, "left", n_items)
    known = F.col("u").isNotNull() & F.col("v").isNotNull()
    err = F.pow(F.col("rating") - dot(F.col("u"), F.col("v"), rank), 2)
    return j.select(
        F.lit(split).alias("split"),
        F.when(known, err).otherwise(F.lit(0.0)).alias("sq"),
        known.alias("known"),
    )


def evaluate_epoch(
    n_train: int,
    test: DataFrame | None,
    user_f: DataFrame,
    item_f: DataFrame,
    rank: int,
    epoch: int,
    n_users: int | None = None,
    n_items: int | None = None,
) -> DataFrame:
    """One row: epoch, train RMSE and test RMSE (sqrt(SSE known / all rows)).

    The train error and the known train pairs are the sums of the ``sse`` and
    ``n`` that the item step wrote per item (it joins only pairs of known
    users); the test error joins the test rows to both factor tables.
    """
    tr = item_f.agg(F.sum("sse").alias("sse"), F.sum("n").alias("n_known")).select(
        F.lit("train").alias("split"),
        "sse",
        F.lit(n_train).cast("long").alias("n_all"),
        F.coalesce("n_known", F.lit(0)).cast("long").alias("n_known"),
    )
    parts = tr
    if test is not None:
        te = rmse_frame(test, user_f, item_f, rank, "test", n_users, n_items).agg(
            F.sum("sq").alias("sse"),
            F.count(F.lit(1)).cast("long").alias("n_all"),
            F.count(F.when(F.col("known"), 1)).cast("long").alias("n_known"),
        )
        parts = parts.unionByName(te.select(F.lit("test").alias("split"), "sse", "n_all", "n_known"))

    def pick(tag, col):
        return F.max(F.when(F.col("split") == tag, F.col(col)))

    return parts.agg(
        F.lit(epoch).alias("epoch"),
        F.sqrt(F.try_divide(pick("train", "sse"), pick("train", "n_all"))).alias("train_rmse"),
        F.sqrt(F.try_divide(pick("test", "sse"), pick("test", "n_all"))).alias("test_rmse"),
        F.coalesce(pick("train", "n_known"), F.lit(0)).cast("long").alias("train_known"),
        F.coalesce(pick("test", "n_known"), F.lit(0)).cast("long").alias("test_known"),
    )


@dataclass
class ExactAlsResult:
    user_factors: DataFrame
    item_factors: DataFrame
    history: DataFrame
    epochs: list[tuple[DataFrame, DataFrame]] = field(default_factory=list)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _write_read(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("error").parquet(path)
    # With the schema at hand no job has to read footers first.
    return spark.read.schema(df.schema).parquet(path)


def als_exact(
    spark: SparkSession,
    train: DataFrame,
    rank: int = 5,
    n_iter: int = 7,
    lam: float = 0.1,
    reg: str = "plain",
    seed: int = 0,
    test: DataFrame | None = None,
    out_dir: str | None = None,
    method: str = "auto",
    block_rows: int = BLOCK_ROWS,
    hot_rows: int | None = None,
    guard: bool = True,
    item_init: DataFrame | None = None,
    keep_epochs: int | None = None,
) -> ExactAlsResult:
    """Fit factors for all users and items of ``train``.

    Rows with a null id or rating are no observations: they are left out in
    every method; equal rows are put together with a weight. Item factors start from a deterministic random vector per id, or from
    ``item_init`` (warm start). User start vectors are never read: the first
    half step overwrites every user.

    ``method``: ``sums`` (broadcast lookup + Catalyst sums), ``blocks``
    (blocked half step, any rank and any factor-table size), or ``auto``:
    sums while the rank is at most 12 and the fixed side's factor table
    fits the broadcast bound, blocks otherwise.

    ``history`` has one row per epoch (epoch, train_rmse, test_rmse,
    train_known, test_known), written to the shared folder as each epoch
    ends, so nothing passes through the driver. ``keep_epochs`` keeps only
    the factors of the last that many epochs on storage (None keeps all).
    """
    out_dir = out_dir or scratch_path(spark, "als")
    parts = spark.sparkContext.defaultParallelism
    ratings = weighted(train).persist(StorageLevel.MEMORY_AND_DISK)
    if test is not None:
        test = test.select("user_id", "item_id", "rating").persist(StorageLevel.MEMORY_AND_DISK)
    n_rows, n_train = ratings.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0.0)).cast("long")).first()

    def pick(n_fixed: int) -> str:
        if method != "auto":
            return method
        small = rank <= SUMS_MAX_RANK and fits_broadcast(spark, n_fixed, rank)
        return "sums" if small else "blocks"

    sides: dict = {}

    def side_for(solve_key: str, fixed_key: str, n_fixed: int):
        """The blocked layout of one side, built once when first needed."""
        how = pick(n_fixed)
        if how == "sums":
            return None
        if how != "blocks":
            raise ValueError(f"unknown method {method!r}")
        if solve_key not in sides:
            sides[solve_key] = blocked_side(
                ratings, solve_key, fixed_key, n_rows, block_rows=block_rows,
                hot_rows=hot_rows, min_blocks=parts,
            )
        return sides[solve_key]

    def step(solve_key, fixed_key, fixed, n_fixed, path):
        side = side_for(solve_key, fixed_key, n_fixed)
        if side is None:
            return _write_read(
                spark, half_step(ratings, fixed, fixed_key, solve_key, rank, lam, reg, guard, n_fixed), path
            )
        return blocked_half_step(spark, side, fixed, n_fixed, rank, lam, reg, guard, path)

    # Warm start: given item factors replace the random ones (ids missing
    # from ``item_init`` fall back to the random vector).
    first = init_factors(ratings, "item_id", rank, seed)
    if item_init is not None:
        first = update_factors(first, item_init.select("id", "features"))
    item_f = _write_read(spark, first, os.path.join(out_dir, "init", "items"))
    # Exact entity counts come from the written factor tables (one row per
    # id), which is what the broadcast bound needs.
    n_items = item_f.count()
    n_users = None
    user_f = None
    history_paths = []
    history_schema = None
    epochs = []
    for k in range(n_iter):
        base = os.path.join(out_dir, f"epoch={k}")
        user_f = step("user_id", "item_id", item_f, n_items, os.path.join(base, "users"))
        if n_users is None:
            n_users = user_f.count()
        item_f = step("item_id", "user_id", user_f, n_users, os.path.join(base, "items"))
        epochs.append((user_f, item_f))
        # The epoch's losses are written now, so its factors are not needed
        # again once the next epoch exists.
        path = os.path.join(out_dir, "history", f"e{k}")
        losses = evaluate_epoch(n_train, test, user_f, item_f, rank, k, n_users, n_items)
        losses.write.mode("error").parquet(path)
        history_schema = losses.schema
        history_paths.append(path)
        if keep_epochs:
            old = [os.path.join(out_dir, "init")] if k == 0 else []
            if k - keep_epochs >= 0:
                old.append(os.path.join(out_dir, f"epoch={k - keep_epochs}"))
            for folder in old:
                _delete(spark, folder)
            epochs = epochs[-keep_epochs:]
    for side in sides.values():
        side.unpersist()
    if user_f is None:
        user_f = _write_read(
            spark, init_factors(ratings, "user_id", rank, seed), os.path.join(out_dir, "init", "users")
        )
    history = spark.read.schema(history_schema).parquet(*history_paths) if history_paths else None
    # Nothing returned depends on the cached inputs any more. Releasing them
    # also keeps a later read of the same, since grown, folder from matching
    # this stale cache.
    ratings.unpersist()
    if test is not None:
        test.unpersist()
    return ExactAlsResult(user_factors=user_f, item_factors=item_f, history=history, epochs=epochs)
