"""Guards and loaders: NaN guard that fires, fields of rating files, one ordering key."""

import numpy as np
import pytest

from ratewise.operators.als_exact import als_exact
from ratewise.operators.profile import nan_guard
from ratewise.operators.recommend import _top_rows, rank_candidates
from ratewise.sources import load_train_test
from ratewise.streaming.refresh import RefreshConfig, StreamRefresher


def test_nan_guard_fires_for_every_action(spark):
    bad = spark.createDataFrame([(1, 1.0), (2, float("nan"))], "id int, b double")
    for action in (lambda d: d.count(), lambda d: d.select("id").collect(),
                   lambda d: d.write.format("noop").mode("overwrite").save()):
        with pytest.raises(Exception, match="NaN in normal equations"):
            action(nan_guard(bad, ["b"]))
    assert nan_guard(bad.where("id = 1"), ["b"]).count() == 1


@pytest.mark.parametrize("line", ["1,2,3.5", "1,2,3.5,99", "1,2,3.5,99,more"])
def test_rating_files_of_three_and_more_fields(spark, tmp_path, line):
    path = tmp_path / "r.csv"
    path.write_text(line + "\nx,2,3\n1,2\n")
    train, test = load_train_test(spark, str(path), str(path))
    assert [tuple(r) for r in train.collect()] == [(1, 2, 3.5)] and test.count() == 1


def test_half_way_scores_order_alike(spark):
    scores = np.array([[2.5e-6, 3e-6, 1e-6, 3.5e-6, 4.5e-6]])
    _, cols = _top_rows(scores, np.arange(5), 5)[:2]
    rows = spark.createDataFrame([(0, i, float(s)) for i, s in enumerate(scores[0])], "user_id int, item_id int, score double")
    got = [r["item_id"] for r in rank_candidates(rows, 5).orderBy("rank").collect()]
    key = np.round(scores[0], 6)
    assert got == sorted(range(5), key=lambda i: (-key[i], i))


def test_null_ratings_are_left_out_in_every_method(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(5)]
    schema = "user_id int, item_id int, rating double"
    clean = spark.createDataFrame(rows, schema)
    dirty = spark.createDataFrame([*rows, (0, 1, None), (None, 1, 2.0), (1, None, 2.0)], schema)
    got = []
    for df, method in ((clean, "sums"), (dirty, "sums"), (dirty, "blocks")):
        res = als_exact(spark, df, rank=2, n_iter=2, method=method)
        got.append({r["id"]: r["features"] for r in res.user_factors.collect()})
        assert res.history.first()["train_known"] == len(rows)
    for other in got[1:]:
        assert got[0].keys() == other.keys()
        assert all(abs(a - b) < 1e-9 for k in got[0] for a, b in zip(got[0][k], other[k], strict=True))


def test_a_retried_batch_refits_the_exact_model(spark, tmp_path):
    ref = StreamRefresher(spark, str(tmp_path), config=RefreshConfig(rank=2, max_iter=1, top_n=2, model="exact"))
    batch = spark.createDataFrame([("1\t1\t3.0 1\t2\t4.0",), ("2\t1\t5.0",)], "value string")
    ref.refresh(batch, 0)
    first = sorted(map(tuple, ref.published().collect()))
    ref.refresh(batch, 0)
    assert sorted(map(tuple, ref.published().collect())) == first
