"""Typed store cells, loaders and their rejects, factor checks, one tagged pass."""

import os
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise import scratch_path
from ratewise.operators import als_exact as ax
from ratewise.operators.als_builtin import fit_als, model_factors
from ratewise.operators.profile import rating_profile, split_train_test, tag_split
from ratewise.operators.recommend import check_top_n, publish_strings, published_rows, top_n_exact
from ratewise.plans import catalog as C
from ratewise.sources import (
    check_ratings_file,
    item_rejects,
    load_train_test,
    read_items_file,
    read_ratings_file,
    train_test_rejects,
    typed_ratings,
)
from ratewise.sources.store import KeyedStore, put_all_ratings, put_ratings, rating_cell_rejects, typed_rating_cells

from sf_paths import SF_SMALL

RATING = "user_id int, item_id int, rating double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text_file(spark, name, lines):
    path = os.path.join(scratch_path(spark, "txt"), name)
    local = urlparse(path).path
    os.makedirs(local)
    with open(os.path.join(local, "part-0.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


@pytest.fixture
def store(spark):
    return KeyedStore(spark, scratch_path(spark, "store"), compact_every=3)


def test_wide_read_takes_the_newest_of_each_cell_in_one_exchange(spark, store):
    rng = np.random.default_rng(2)
    want = {}
    for n in range(8):  # compaction after every third put
        rows = [(f"k{int(rng.integers(0, 6))}", q, f"{n}-{i}") for i, q in enumerate(rng.choice(["a", "b", "c"], 4))]
        rows = list({(k, q): (k, q, v) for k, q, v in rows}.values())
        want.update({(k, q): v for k, q, v in rows})
        store.put("t", spark.createDataFrame(rows, "rowkey string, qualifier string, value string").withColumn("family", F.lit("msg")))
        wide = store.read_wide("t", ["a", "b"])
        got = {(r.rowkey, q): r[q] for r in wide.collect() for q in ("a", "b") if r[q] is not None}
        assert got == {k: v for k, v in want.items() if k[1] != "c"}
        assert {r[0] for r in store.keys("t").collect()} == {k for k, _ in want}
    assert plan(store.read_wide("t", ["a", "b"])).count("Exchange") == 1
    assert plan(store.keys("t")).count("Exchange") == 1
    assert store.read_wide("none", ["a"]).collect() == [] and store.keys("none").collect() == []


def test_upsert_query_reads_with_one_exchange(spark):
    assert plan(C.q_kv_upsert(spark, SF_SMALL)).count("Exchange") == 1


def test_every_rating_comes_back_typed(spark, store):
    rows = [(1, 2, 3.0, "t1"), (1, 2, 3.0, "t1"), (1, 2, 4.0, "t1"), (5, 6, 1.5, None)]
    put_all_ratings(store, "all", spark.createDataFrame(rows, RATING + ", ts string"))
    got = sorted(tuple(r) for r in typed_rating_cells(store, "all").drop("rowkey").collect())
    assert got == [(1, 2, 3.0), (1, 2, 3.0), (1, 2, 4.0), (5, 6, 1.5)]


def test_rating_cells_that_do_not_parse_are_rejects(spark, store):
    put_ratings(store, "t", spark.createDataFrame([(1, 2, 3.0, "a"), (4, 5, 2.0, "b")], RATING + ", k string"), F.col("k"))
    bad = spark.createDataFrame([("c", "x", "1", "2.0"), ("d", "1", None, "2.0")], "k string, u string, i string, r string")
    store.put_columns("t", bad, "k", {"userId": "u", "movieId": "i", "rating": "r"})
    assert sorted(map(tuple, typed_rating_cells(store, "t").collect())) == [("a", 1, 2, 3.0), ("b", 4, 5, 2.0)]
    assert sorted(map(tuple, rating_cell_rejects(store, "t").collect())) == [("c", "x", "1", "2.0"), ("d", "1", None, "2.0")]


def test_loader_and_dry_run_have_one_rule(spark):
    lines = ["1,2,3.5", "1,2,3.5,99", "1,2,3.5,99,more", "x,2,3", "1,2", "1,y,3,9", ""]
    path = text_file(spark, "ratings", lines)
    train, test = load_train_test(spark, path, path)
    counts = check_ratings_file(spark, path).first()
    typed = typed_ratings(read_ratings_file(spark, path)).count()
    assert train.count() == test.count() == typed == counts.n_good == 3
    rejects = train_test_rejects(spark, path, path).collect()
    assert len(rejects) == 2 * counts.n_bad == 6
    assert {(r.split, r.user) for r in rejects} == {(s, u) for s in ("train", "test") for u in ("x", "1")}


def test_item_lines_without_id_or_name_are_rejects(spark):
    path = text_file(spark, "items", ["1,Heat,9.5", "2,Up", ",Ran,7", "4", '5,"a, b",1,more'])
    assert sorted(r.movie_id for r in read_items_file(spark, path).collect()) == ["1", "2", "5"]
    got = sorted((str(r.movie_id), str(r.name), str(r.line)) for r in item_rejects(spark, path).collect())
    assert got == [("4", "None", "4"), ("None", "Ran", "None")]


def small_ratings(spark):
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(25) for i in range(18) if rng.random() < 0.5]
    return spark.createDataFrame(rows + rows[:30], RATING)


def test_factor_check_of_the_library_fit(spark):
    ratings = small_ratings(spark)
    users, items = model_factors(fit_als(spark, ratings, rank=3, max_iter=4, reg=0.1))
    observed = ax.weighted(ratings)
    good = ax.check_factors(observed, items, users, "item_id", "user_id", 3, 0.1, "count").collect()
    assert len(good) == 25 and all(r.solved for r in good)
    assert sum(r.n for r in good) == ratings.count()
    # Another regularisation, a moved factor and a missing one are found.
    assert not any(r.solved for r in ax.check_factors(observed, items, users, "item_id", "user_id", 3, 0.1, "plain").collect())
    moved = users.where("id <> 7").withColumn(
        "features", F.when(F.col("id") == 3, F.transform("features", lambda x: x + 0.01)).otherwise(F.col("features")))
    got = {r.id: r.solved for r in ax.check_factors(observed, items, moved, "item_id", "user_id", 3, 0.1, "count").collect()}
    assert {u for u, ok in got.items() if not ok} == {3, 7}


def test_factor_check_of_the_exact_fit_at_rank_one(spark):
    ratings = small_ratings(spark)
    res = ax.als_exact(spark, ratings, rank=1, n_iter=2)
    ok = ax.check_factors(ax.weighted(ratings), res.user_factors, res.item_factors, "user_id", "item_id", 1, 0.1).collect()
    assert len(ok) == 18 and all(r.solved for r in ok)


def test_published_strings_are_checked_by_their_items(spark):
    ratings = small_ratings(spark)
    res = ax.als_exact(spark, ratings, rank=2, n_iter=1)
    top = top_n_exact(spark, res.user_factors, res.item_factors, 2, 4)
    texts = publish_strings(top).select(F.col("user_id").cast("string").alias("rowkey"), F.col("rec_movies").alias("recMovies"))
    back = published_rows(texts, res.user_factors, res.item_factors, 2)
    assert back.count() == 25 * 4
    assert all(r.ordered and r.optimal for r in check_top_n(spark, back, res.user_factors, res.item_factors, 2, 4).collect())


def test_profile_is_one_scan_and_one_pass(spark):
    p = plan(C.q_rating_profile(spark, SF_SMALL))
    assert p.count("l_orderkey") and len([line for line in p.splitlines() if "FileScan parquet" in line and "lineitem" in line]) == 1
    ratings = small_ratings(spark)
    train, test = split_train_test(ratings)
    got = rating_profile(tag_split(ratings)).first()
    assert (got.n_train, got.n_test) == (train.count(), test.count())
    assert got.n_users == train.select("user_id").distinct().count()
