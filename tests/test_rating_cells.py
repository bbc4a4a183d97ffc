"""Ratings as cells: written without a second shuffle, read back by hashing."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ratewise.session import scratch_path
from ratewise.sources.store import KeyedStore, put_all_ratings, typed_rating_cells


@pytest.fixture
def store(spark):
    return KeyedStore(spark, scratch_path(spark, "cells"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ratings_are_put_without_a_second_shuffle(spark, store, monkeypatch):
    day = datetime(2024, 1, 2)
    rows = [(1, 2, 3.0, day), (1, 2, 3.0, day), (1, 2, 4.0, day), (5, 6, 1.5, None), (None, 6, 1.5, day)]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, rating double, ts timestamp_ntz")
    plans = []
    put = KeyedStore.put_columns

    def seen(self, table, rows, key, cells, **more):
        plans.append((plan(rows).count("Exchange"), more))
        return put(self, table, rows, key, cells, **more)

    monkeypatch.setattr(KeyedStore, "put_columns", seen)
    put_all_ratings(store, "all", ratings)
    assert plans == [(1, {"distinct": True})]
    read = typed_rating_cells(store, "all").drop("rowkey")
    how = plan(read)
    assert sorted(map(tuple, read.collect())) == [(1, 2, 3.0), (1, 2, 3.0), (1, 2, 4.0), (5, 6, 1.5)]
    # Numbers are aggregated by hashing: no sort of all cells before and after the exchange.
    assert "SortAggregate" not in how and how.count("HashAggregate") == 2


def test_keys_that_may_meet_are_still_brought_together(spark, store):
    # A null and an empty time have one row key: one cell each is kept, as a put does.
    rows = [(1, 2, 3.0, None), (1, 2, 3.0, "")]
    put_all_ratings(store, "text", spark.createDataFrame(rows, "user_id int, item_id int, rating double, ts string"))
    assert store.read_cells("text").count() == 4


def test_typed_read_takes_the_newest_cell_even_if_it_does_not_parse(spark, store):
    def put(rating, copies):
        row = spark.createDataFrame([("a", "1", "2", rating, copies)], "k string, u string, i string, r string, c string")
        store.put_columns("t", row, "k", {"userId": "u", "movieId": "i", "rating": "r", "copies": "c"})

    put("3.0", "2")
    assert sorted(map(tuple, typed_rating_cells(store, "t").collect())) == [("a", 1, 2, 3.0)] * 2
    put("x", "2")
    assert typed_rating_cells(store, "t").collect() == []
    put("4.5", "x")
    assert sorted(map(tuple, typed_rating_cells(store, "t").collect())) == [("a", 1, 2, 4.5)]
    assert store.read_wide("t", ["rating"]).select(F.col("rating")).first()[0] == "4.5"
