import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import als_exact as ax
from ratewise.operators.als_builtin import fit_als, model_factors
from ratewise.operators.evaluate import rmse


def planted(spark, n_users=60, n_items=40, rank=2, density=0.5, noise=0.05, seed=7, hot_user=None):
    rng = np.random.default_rng(seed)
    u = rng.normal(size=(n_users, rank))
    v = rng.normal(size=(n_items, rank))
    mask = rng.random((n_users, n_items)) < density
    if hot_user is not None:
        mask[hot_user, :] = True
    us, its = np.nonzero(mask)
    r = (u[us] * v[its]).sum(axis=1) + noise * rng.normal(size=len(us))
    pdf = pd.DataFrame({"user_id": us.astype("int32"), "item_id": its.astype("int32"), "rating": r})
    return spark.createDataFrame(pdf, "user_id int, item_id int, rating double")


def to_dict(f):
    return {r.id: np.array(r.features) for r in f.collect()}


def ridge(ratings_pdf, fixed, key, other, lam, count=False):
    out = {}
    for k, g in ratings_pdf.groupby(key):
        q = np.stack([fixed[i] for i in g[other]])
        a = q.T @ q + lam * (len(g) if count else 1) * np.eye(q.shape[1])
        out[k] = np.linalg.solve(a, q.T @ g["rating"].to_numpy())
    return out


def test_half_step_matches_numpy_ridge(spark):
    df = planted(spark)
    pdf = df.toPandas()
    items0 = ax.init_factors(df, "item_id", 3, seed=5)
    users1 = to_dict(ax.half_step(df, items0, "item_id", "user_id", 3, 0.1))
    expect = ridge(pdf, to_dict(items0), "user_id", "item_id", 0.1)
    assert set(users1) == set(expect)
    for k in expect:
        np.testing.assert_allclose(users1[k], expect[k], rtol=1e-10, atol=1e-12)


def numpy_als(pdf, rank, lam, count, epochs, seed=0):
    rng = np.random.default_rng(seed)
    items = {i: rng.uniform(-1, 1, rank) for i in pdf.item_id.unique()}
    for _ in range(epochs):
        users = ridge(pdf, items, "user_id", "item_id", lam, count)
        items = ridge(pdf, users, "item_id", "user_id", lam, count)
    return users, items


@pytest.mark.parametrize("reg", ["plain", "count"])
def test_fixed_point_at_convergence(spark, reg):
    """Started at a converged model, every factor stays its own ridge solve."""
    lam, count = (0.5, False) if reg == "plain" else (0.05, True)
    df = planted(spark, noise=0.01)
    pdf = df.toPandas()
    users_np, items_np = numpy_als(pdf, 2, lam, count, 300)
    init = spark.createDataFrame(
        pd.DataFrame({"id": np.array(list(items_np), dtype="int32"), "features": list(items_np.values())}),
        "id int, features array<double>",
    )
    res = ax.als_exact(spark, df, rank=2, n_iter=2, lam=lam, reg=reg, item_init=init)
    users, items = to_dict(res.user_factors), to_dict(res.item_factors)
    again = ridge(pdf, items, "user_id", "item_id", lam, count)
    assert max(np.abs(users[k] - again[k]).max() for k in users) < 1e-8
    assert max(np.abs(items[k] - items_np[k]).max() for k in items) < 1e-8
    assert max(np.abs(users[k] - users_np[k]).max() for k in users) < 1e-8


def test_planted_rmse_falls_to_noise(spark):
    df = planted(spark, n_users=80, n_items=50, noise=0.05)
    train = df.where(F.pmod(F.col("user_id") + F.col("item_id"), F.lit(7)) != 0)
    test = df.where(F.pmod(F.col("user_id") + F.col("item_id"), F.lit(7)) == 0)
    res = ax.als_exact(spark, train, rank=2, n_iter=8, lam=0.01, test=test)
    hist = sorted(res.history.collect(), key=lambda r: r.epoch)
    tr = [r.train_rmse for r in hist]
    assert all(b <= a + 1e-9 for a, b in zip(tr, tr[1:]))
    assert tr[-1] < 0.08
    assert hist[-1].test_rmse < 0.2


def test_methods_and_shuffle_paths_agree(spark):
    df = planted(spark, rank=3, hot_user=0)
    base = ax.als_exact(spark, df, rank=3, n_iter=2, lam=0.1, method="sums")
    blocked = ax.als_exact(spark, df, rank=3, n_iter=2, lam=0.1, method="blocks", block_rows=200)
    # Hot keys (over 10 ratings) split across blocks and merge partial sums.
    salted = ax.als_exact(spark, df, rank=3, n_iter=2, lam=0.1, method="blocks", hot_rows=10)
    for pick in (lambda r: r.item_factors, lambda r: r.user_factors):
        b = to_dict(pick(base))
        for other in (blocked, salted):
            o = to_dict(pick(other))
            assert set(o) == set(b)
            for k in b:
                np.testing.assert_allclose(o[k], b[k], rtol=1e-8, atol=1e-10)


def test_count_form_close_to_builtin(spark):
    df = planted(spark, n_users=100, n_items=60, noise=0.05, density=0.6)
    mine = ax.als_exact(spark, df, rank=2, n_iter=15, lam=0.05, reg="count")
    model = fit_als(spark, df, rank=2, max_iter=15, reg=0.05)
    uf, itf = model_factors(model)
    a = rmse(df, mine.user_factors, mine.item_factors, 2).first().rmse
    b = rmse(df, uf, itf, 2).first().rmse
    assert abs(a - b) < 0.02


def test_cold_start_pairs_count_in_denominator(spark):
    train = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0), (2, 1, 5.0), (2, 2, 2.0)], "user_id int, item_id int, rating double")
    test = spark.createDataFrame([(1, 1, 4.0), (9, 1, 3.0), (1, 9, 3.0), (9, 9, 1.0)], "user_id int, item_id int, rating double")
    res = ax.als_exact(spark, train, rank=2, n_iter=3, lam=0.1)
    full = rmse(test, res.user_factors, res.item_factors, 2).first()
    known = rmse(test.limit(1), res.user_factors, res.item_factors, 2).first()
    assert (full.n_all, full.n_known) == (4, 1)
    assert full.sse == pytest.approx(known.sse)
    assert full.rmse == pytest.approx((known.sse / 4) ** 0.5)


def test_duplicate_pairs_are_separate_observations(spark):
    one = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0)], "user_id int, item_id int, rating double")
    dup = spark.createDataFrame([(1, 1, 4.0), (1, 1, 4.0), (1, 2, 2.0)], "user_id int, item_id int, rating double")
    items = ax.init_factors(one, "item_id", 2)
    a = to_dict(ax.half_step(one, items, "item_id", "user_id", 2, 0.1))[1]
    b = to_dict(ax.half_step(dup, items, "item_id", "user_id", 2, 0.1))[1]
    assert not np.allclose(a, b)


def test_nan_guard_fails_the_job(spark):
    df = spark.createDataFrame([(1, 1, float("nan"))], "user_id int, item_id int, rating double")
    items = ax.init_factors(df, "item_id", 2)
    with pytest.raises(Exception, match="NaN"):
        ax.half_step(df, items, "item_id", "user_id", 2, 0.1).collect()


def test_update_keeps_unsolved(spark):
    old = spark.createDataFrame([(1, [1.0, 1.0]), (2, [2.0, 2.0])], "id int, features array<double>")
    new = spark.createDataFrame([(2, [5.0, 5.0])], "id int, features array<double>")
    got = {r.id: r.features for r in ax.update_factors(old, new).collect()}
    assert got == {1: [1.0, 1.0], 2: [5.0, 5.0]}


def test_empty_test_set_gives_no_test_rmse(spark):
    train = planted(spark, n_users=10, n_items=8)
    empty = train.limit(0)
    res = ax.als_exact(spark, train, rank=2, n_iter=1, lam=0.1, test=empty)
    row = res.history.first()
    assert row.test_rmse is None and row.test_known == 0
    assert row.train_known == train.count()


def test_refit_on_grown_folder_sees_new_rows(spark):
    from ratewise import scratch_path

    path = scratch_path(spark, "grow")
    first = planted(spark, n_users=12, n_items=9, seed=1)
    first.write.parquet(path + "/b=0")
    r1 = ax.als_exact(spark, spark.read.parquet(path), rank=2, n_iter=1, lam=0.1)
    planted(spark, n_users=12, n_items=9, seed=2).write.parquet(path + "/b=1")
    grown = spark.read.parquet(path)
    r2 = ax.als_exact(spark, grown, rank=2, n_iter=1, lam=0.1)
    assert r1.history.first().train_known == first.count()
    assert r2.history.first().train_known == grown.count()


def test_keep_epochs_drops_old_factors_but_keeps_history(spark):
    import os
    from urllib.parse import urlparse

    from ratewise import scratch_path

    df = planted(spark, n_users=20, n_items=12)
    out = scratch_path(spark, "keep")
    res = ax.als_exact(spark, df, rank=2, n_iter=3, lam=0.1, test=df, out_dir=out, keep_epochs=1)
    left = sorted(os.listdir(urlparse(out).path))
    assert left == ["epoch=2", "history"]
    assert sorted(r.epoch for r in res.history.collect()) == [0, 1, 2]
    assert len(res.epochs) == 1 and res.item_factors.count() == 12
