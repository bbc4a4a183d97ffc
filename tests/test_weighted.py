"""Equal observations as one weighted row; joins that go by exact size; one tagged pass."""

import numpy as np
import pytest

from ratewise.operators import als_exact as ax
from ratewise.operators.blocks import blocked_half_step, blocked_side
from ratewise.operators.evaluate import known_pairs, predict_pairs, rmse
from ratewise.operators.joins import BROADCAST_LIMIT_CONF

SCHEMA = "user_id int, item_id int, rating double"


def as_dict(factors):
    return {r["id"]: r["features"] for r in factors.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    assert all(np.allclose(a[k], b[k], rtol=1e-9, atol=1e-9) for k in a)


@pytest.fixture
def hot_rows():
    """User 0 rates item 0 alike 900 times out of 1,000 rows."""
    rng = np.random.default_rng(3)
    rows = [(0, 0, 4.0)] * 900
    rows += [(int(rng.integers(0, 12)), int(rng.integers(0, 9)), float(rng.integers(1, 6))) for _ in range(100)]
    return rows


@pytest.fixture
def one_byte(spark):
    spark.conf.set(BROADCAST_LIMIT_CONF, "1")
    yield
    spark.conf.unset(BROADCAST_LIMIT_CONF)


def numpy_half_step(rows, items, rank, lam, count):
    out = {}
    for u in {r[0] for r in rows}:
        q = np.array([items[i] for x, i, _ in rows if x == u])
        r = np.array([v for x, _, v in rows if x == u])
        lam_u = lam * len(r) if count else lam
        out[u] = np.linalg.solve(q.T @ q + lam_u * np.eye(rank), q.T @ r)
    return out


def test_weights_sum_to_the_rows(spark, hot_rows):
    df = spark.createDataFrame([*hot_rows, (None, 1, 2.0), (1, None, 2.0), (1, 1, None)], SCHEMA)
    got = ax.weighted(df)
    assert got.agg({"weight": "sum"}).first()[0] == 1000
    assert got.count() == len(set(hot_rows))


@pytest.mark.parametrize("reg", ["plain", "count"])
@pytest.mark.parametrize("method", ["sums", "blocks"])
def test_weighted_half_step_equals_all_rows(spark, hot_rows, reg, method):
    df = ax.weighted(spark.createDataFrame(hot_rows, SCHEMA))
    items_f = ax.init_factors(df, "item_id", 3)
    want = numpy_half_step(hot_rows, {k: np.array(v) for k, v in as_dict(items_f).items()}, 3, 0.1, reg == "count")
    if method == "sums":
        got = ax.half_step(df, items_f, "item_id", "user_id", 3, 0.1, reg)
    else:
        side = blocked_side(df, "user_id", "item_id", df.count(), blocks=3, block_rows=20, hot_rows=5)
        got = blocked_half_step(spark, side, items_f, items_f.count(), 3, 0.1, reg)
    rows = got.collect()
    same({r["id"]: r["features"] for r in rows}, want)
    assert sum(r["n"] for r in rows) == len(hot_rows)


def test_no_block_holds_a_hot_key_of_equal_rows(spark, hot_rows):
    df = ax.weighted(spark.createDataFrame(hot_rows * 5, SCHEMA))
    n = df.count()
    side = blocked_side(df, "user_id", "item_id", n, block_rows=60, hot_rows=15)
    sizes = [r["count"] for r in side.ratings.groupBy("_blk").count().collect()]
    assert max(sizes) <= 60 and sum(sizes) == n
    side.unpersist()


def test_known_train_pairs_are_counted(spark, hot_rows):
    df = spark.createDataFrame(hot_rows, SCHEMA)
    for method in ("sums", "blocks"):
        res = ax.als_exact(spark, df, rank=2, n_iter=2, method=method)
        assert [r["train_known"] for r in res.history.collect()] == [1000, 1000]
    # A warm start without an item leaves that item's pairs out of nothing: every item gets a start vector.
    assert res.item_factors.agg({"n": "sum"}).first()[0] == 1000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_broadcast_beyond_the_bound(spark, hot_rows, one_byte):
    df = ax.weighted(spark.createDataFrame(hot_rows, SCHEMA))
    items_f = ax.init_factors(df, "item_id", 2).persist()
    users_f = ax.init_factors(df, "user_id", 2).persist()
    raw = spark.createDataFrame(hot_rows, SCHEMA)
    frames = [ax.half_step(df, items_f, "item_id", "user_id", 2, 0.1), predict_pairs(spark, raw, users_f, items_f, 2),
              known_pairs(spark, raw, users_f, items_f, 2), rmse(raw, users_f, items_f, 2)]
    beyond = []
    for f in frames:
        assert "BroadcastHashJoin" not in plan(f) and "SortMergeJoin" in plan(f)
        beyond.append(sorted(map(str, f.collect())))
    side = blocked_side(df, "user_id", "item_id", df.count(), block_rows=20, hot_rows=5)
    assert side.has_split
    blocked = blocked_half_step(spark, side, items_f, 9, 2, 0.1)
    assert "BroadcastHashJoin" not in plan(blocked)
    a = as_dict(blocked)
    spark.conf.unset(BROADCAST_LIMIT_CONF)
    same(a, as_dict(ax.half_step(df, items_f, "item_id", "user_id", 2, 0.1)))
    within = predict_pairs(spark, raw, users_f, items_f, 2)
    assert "BroadcastHashJoin" in plan(within)
    assert sorted(map(str, within.collect())) == beyond[1]
    side.unpersist()
