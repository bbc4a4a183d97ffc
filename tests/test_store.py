import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ratewise import scratch_path
from ratewise.sources.store import KeyedStore

KEYS = ["a", "b", "c"]
QUALS = ["x", "y"]


def _apply(store, table, batch):
    df = store.spark.createDataFrame(
        [(k, "msg", q, v, i) for i, (k, q, v) in enumerate(batch)],
        "rowkey string, family string, qualifier string, value string, seq int",
    )
    store.put(table, df, ["seq"])


put = st.tuples(st.sampled_from(KEYS), st.sampled_from(QUALS), st.one_of(st.none(), st.text("pqr", min_size=1, max_size=2)))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(put, max_size=6), min_size=1, max_size=4))
def test_upsert_matches_dict_model(spark, batches):
    # Compaction every 3 puts: reads cover one delta, several deltas, and
    # a base with deltas after it.
    store = KeyedStore(spark, scratch_path(spark, "kv"), compact_every=3, keep_bases=None)
    model = {}
    history = []
    for batch in batches:
        _apply(store, "t", batch)
        for k, q, v in batch:
            if v is not None:
                model[(k, q)] = v
        history.append(dict(model))
        got = {(r.rowkey, r.qualifier): r.value for r in store.read_cells("t").collect()}
        assert got == model
    assert sorted(r.rowkey for r in store.keys("t").collect()) == sorted({k for k, _ in model})
    # Every earlier version stays readable as it was.
    for n, snap in enumerate(history):
        old = {(r.rowkey, r.qualifier): r.value for r in store.read_cells("t", n).collect()}
        assert old == snap


def test_partial_put_keeps_other_cells(spark):
    store = KeyedStore(spark, scratch_path(spark, "kv"))
    rows = spark.createDataFrame([(1, "u1", "n1"), (2, "u2", "n2")], "id int, a string, b string")
    store.put_columns("t", rows, "id", {"a": "a", "b": "b"})
    upd = spark.createDataFrame([(1, "u1new")], "id int, a string")
    store.put_columns("t", upd, "id", {"a": "a"})
    wide = {r.rowkey: (r.a, r.b) for r in store.read_wide("t", ["a", "b"]).collect()}
    assert wide == {"1": ("u1new", "n1"), "2": ("u2", "n2")}
    assert store.versions("t") == [0, 1]
    # The old version is untouched.
    old = {r.rowkey: r.a for r in store.read_wide("t", ["a"]).collect()}
    assert old["1"] == "u1new"
    v0 = {(r.rowkey, r.qualifier): r.value for r in store.read_cells("t", 0).collect()}
    assert v0[("1", "a")] == "u1"


def test_last_put_wins_by_order_not_arrival(spark):
    store = KeyedStore(spark, scratch_path(spark, "kv"))
    seq = list(range(20))
    random.Random(3).shuffle(seq)
    rows = spark.createDataFrame([("k", "msg", "x", f"v{s:02d}", s) for s in seq],
                                 "rowkey string, family string, qualifier string, value string, seq int")
    store.put("t", rows, ["seq"])
    assert store.read_cells("t").first().value == "v19"


def test_failed_attempt_leftover_is_ignored_and_replaced(spark):
    from urllib.parse import urlparse
    import os

    store = KeyedStore(spark, scratch_path(spark, "kv"))
    _apply(store, "t", [("a", "x", "p")])
    # A put that died before its commit left a folder without _SUCCESS.
    os.makedirs(urlparse(store.table_path("t")).path + "/delta=1")
    assert store.versions("t") == [0]
    _apply(store, "t", [("a", "x", "q")])
    assert store.versions("t") == [0, 1]
    assert store.read_cells("t").first().value == "q"


def test_null_or_empty_keys_are_not_puts(spark):
    store = KeyedStore(spark, scratch_path(spark, "kv"))
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (2, None)], "id int, v string")
    store.put_columns("t", rows, "id", {"v": "v"})
    empty = spark.createDataFrame([("", "c")], "id string, v string")
    store.put_columns("t", empty, "id", {"v": "v"})
    assert [(r.rowkey, r.value) for r in store.read_cells("t").collect()] == [("1", "b")]


def test_vacuum_keeps_newest_bases_and_later_versions(spark):
    store = KeyedStore(spark, scratch_path(spark, "kv"), compact_every=2, keep_bases=1)
    model, snaps = {}, []
    for i in range(6):
        batch = [("a", "x", f"v{i}"), (f"k{i}", "y", "w")]
        _apply(store, "t", batch)
        for k, q, v in batch:
            model[(k, q)] = v
        snaps.append(dict(model))
    # Compactions at puts 1, 3 and 5; only base 5 is kept, no delta before it.
    kinds = store._layers("t")
    assert [layer for layer in kinds if layer[1] == "base"] == [(5, "base")]
    assert all(n > 5 for n, k in kinds if k == "delta") or not [n for n, k in kinds if k == "delta"]
    got = {(r.rowkey, r.qualifier): r.value for r in store.read_cells("t").collect()}
    assert got == snaps[-1]
    _apply(store, "t", [("a", "x", "z")])
    assert store.read_cells("t").where("rowkey = 'a'").first().value == "z"
