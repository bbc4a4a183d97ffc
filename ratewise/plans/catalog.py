"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or data Spark derives from them) in
full. Floating results are rounded at this layer only, with the same
digits as the SQL checks, so summation order cannot flip a comparison.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.vectors import vector_columns
from ratewise.operators import als_exact as ax
from ratewise.operators.als_builtin import fit_als, model_factors
from ratewise.operators.evaluate import known_pairs, predict_pairs, rmse
from ratewise.operators.profile import (
    entity_lists,
    nan_guard,
    rating_profile,
    split_flag,
    split_train_test,
    tag_split,
)
from ratewise.operators.recommend import (
    affected_users,
    check_top_n,
    publish_strings,
    published_rows,
    top_n_exact,
)
from ratewise.plans import params as P
from ratewise.session import scratch_path
from ratewise.sources import (
    check_ratings_file,
    item_rejects,
    items_table,
    load_train_test,
    parse_stream_lines,
    ratings_b,
    ratings_s,
    read_items_file,
    read_ratings_file,
    to_tsv,
    train_test_rejects,
    users_table,
    write_csv,
)
from ratewise.sources.store import KeyedStore, put_all_ratings, put_ratings, typed_rating_cells
from ratewise.sources.text import TS_FORMAT
from ratewise.streaming.refresh import RefreshConfig, StreamRefresher
from ratewise.streaming.replay import SlotReplay, write_replay

Query = Callable[[SparkSession, str], DataFrame]


# -- shared inputs -------------------------------------------------------------
def _train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    tt = ratings_b(spark, sf).select("user_id", "item_id", "rating")
    return split_train_test(tt, P.SPLIT_TEST_MOD, P.SPLIT_COLD_MOD)


def _exact(spark: SparkSession, sf: str, epochs: int, reg: str = "plain") -> ax.ExactAlsResult:
    train, test = _train_test(spark, sf)
    return ax.als_exact(
        spark, train, rank=P.EXACT_RANK, n_iter=epochs, lam=P.EXACT_LAMBDA,
        seed=P.EXACT_SEED, test=test, reg=reg,
    )


def _factor_rows(f: DataFrame, id_name: str, digits: int = P.FACTOR_DIGITS) -> DataFrame:
    return f.select(
        F.col("id").alias(id_name), *vector_columns(F.col("features"), P.EXACT_RANK, "f", digits)
    )


def _store(spark: SparkSession) -> KeyedStore:
    return KeyedStore(spark, scratch_path(spark, "store"))


# -- A: scans, sources, sinks --------------------------------------------------
def q_scan_items(spark, sf):
    path = write_csv(
        items_table(spark, sf).select(
            F.col("item_id").alias("movie_id"), "name", F.col("price").cast("string")
        ),
        scratch_path(spark, "items_csv"),
    )
    return read_items_file(spark, path)


def q_scan_ratings(spark, sf):
    path = write_csv(ratings_b(spark, sf), scratch_path(spark, "ratings_csv"))
    return read_ratings_file(spark, path).select("user", "movie", "rating", "time")


def q_scan_check(spark, sf):
    root = scratch_path(spark, "check_csv")
    write_csv(ratings_b(spark, sf), os.path.join(root, "good"))
    # Event rows carry a word where the user id belongs: bad lines.
    ev = ratings_s(spark, sf).join(
        spark.read.parquet(os.path.join(sf, "events.parquet")).select("event_id", "event_type"),
        "event_id",
    )
    write_csv(ev.select("event_type", "item_id", "rating", "ts"), os.path.join(root, "bad"))
    return check_ratings_file(spark, [os.path.join(root, "good"), os.path.join(root, "bad")])


def q_ratings_typed(spark, sf):
    # Every rating put as cells, and read back typed.
    store = _store(spark)
    put_all_ratings(store, "t_ratings", ratings_b(spark, sf))
    return typed_rating_cells(store, "t_ratings").drop("rowkey")


def q_load_train_test(spark, sf):
    # A train file of three fields a line and a test file of five.
    train, test = _train_test(spark, sf)
    root = scratch_path(spark, "split_csv")
    write_csv(train, os.path.join(root, "train"))
    write_csv(test.withColumns({"time": F.lit("2024-01-01 00:00:00"), "more": F.lit("x")}), os.path.join(root, "test"))
    loaded = load_train_test(spark, os.path.join(root, "train"), os.path.join(root, "test"))
    return loaded[0].withColumn("split", F.lit("train")).unionByName(loaded[1].withColumn("split", F.lit("test")))


def q_load_rejects(spark, sf):
    # Event rows carry a word where the user id belongs, part rows no name.
    root = scratch_path(spark, "reject_csv")
    train, _ = _train_test(spark, sf)
    write_csv(train, os.path.join(root, "train"))
    ev = ratings_s(spark, sf).join(
        spark.read.parquet(os.path.join(sf, "events.parquet")).select("event_id", "event_type"), "event_id")
    write_csv(ev.select("event_type", "item_id", "rating"), os.path.join(root, "test"))
    write_csv(items_table(spark, sf).select("item_id", F.lit(None).cast("string").alias("name"), "price"), os.path.join(root, "items"))
    lines = train_test_rejects(spark, os.path.join(root, "train"), os.path.join(root, "test")).select(
        F.col("split").alias("file"), F.col("user").alias("first"), F.col("movie").alias("second"), F.col("rating").alias("third"))
    items = item_rejects(spark, os.path.join(root, "items")).select(
        F.lit("items").alias("file"), F.col("movie_id").alias("first"), F.col("name").alias("second"), F.col("price").alias("third"))
    return lines.unionByName(items)


def q_train_test_split(spark, sf):
    rb = ratings_b(spark, sf)
    flag = split_flag(F.col("user_id"), F.col("item_id"), P.SPLIT_TEST_MOD, P.SPLIT_COLD_MOD)
    return rb.select(
        "user_id", "item_id", "rating", "ts",
        F.when(flag, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


def _seeded_users(spark, sf) -> tuple[KeyedStore, str]:
    store = _store(spark)
    store.put_columns("t_users", users_table(spark, sf), "user_id", {"uid": F.col("user_id")})
    return store, "t_users"


def q_seed_users(spark, sf):
    store, t = _seeded_users(spark, sf)
    return store.read_wide(t, ["uid"])


def _users_with_last_item(spark, sf) -> tuple[KeyedStore, str]:
    store, t = _seeded_users(spark, sf)
    rs = ratings_s(spark, sf)
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    order = ["ts", "event_id"]
    # Two put rounds; the later round wins per cell, other cells stay.
    store.put_columns(t, rs.where(F.col("ts") < mid), "user_id", {"lastItem": "item_id"}, order=order)
    store.put_columns(t, rs.where(F.col("ts") >= mid), "user_id", {"lastItem": "item_id"}, order=order)
    return store, t


def q_kv_upsert(spark, sf):
    store, t = _users_with_last_item(spark, sf)
    return store.read_wide(t, ["uid", "lastItem"]).select(
        "rowkey", "uid", F.col("lastItem").alias("last_item")
    )


def q_store_keys(spark, sf):
    store, t = _users_with_last_item(spark, sf)
    return store.keys(t)


def _by_time(spark, sf) -> KeyedStore:
    store = _store(spark)
    put_ratings(store, "t_ratings", ratings_b(spark, sf), F.date_format("ts", TS_FORMAT),
                order=["user_id", "item_id", "rating"])
    return store


def q_ratings_by_time(spark, sf):
    return _by_time(spark, sf).read_wide("t_ratings", ["userId", "movieId", "rating"])


def q_rating_cells_typed(spark, sf):
    return typed_rating_cells(_by_time(spark, sf), "t_ratings")


def _stream_lines(spark, sf, slots: int) -> str:
    return write_replay(
        ratings_s(spark, sf), scratch_path(spark, "replay"), slots=slots,
        line_key="event_id", records_per_line=P.RECORDS_PER_LINE,
    )


def _slot_replay(spark, sf, slots: int) -> SlotReplay:
    return SlotReplay(
        ratings_s(spark, sf), slots, line_key="event_id", records_per_line=P.RECORDS_PER_LINE
    )


def q_stream_ratings(spark, sf):
    src = _stream_lines(spark, sf, 1)
    out = scratch_path(spark, "stream_sink")
    lines = spark.readStream.format("text").load(src)
    q = (
        parse_stream_lines(lines)
        .writeStream.format("parquet")
        .option("checkpointLocation", out + "_ckpt")
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return spark.read.parquet(out)


def q_replay_batches(spark, sf):
    rep = _slot_replay(spark, sf, P.REPLAY_SLOTS)
    src = scratch_path(spark, "replay")
    out = scratch_path(spark, "replay_sink")

    def trigger_once():
        lines = spark.readStream.format("text").load(src)
        q = (
            parse_stream_lines(lines, keep=["slot"])
            .writeStream.format("parquet")
            .option("checkpointLocation", out + "_ckpt")
            .trigger(availableNow=True)
            .start(out)
        )
        q.awaitTermination()

    rep.run(src, trigger_once)
    rep.release()
    return spark.read.parquet(out).select("user_id", "item_id", "rating", "slot")


def _refresher(
    spark, sf, slots: int, refit_every: int, config: RefreshConfig | None = None, seed: DataFrame | None = None
) -> StreamRefresher:
    rep = _slot_replay(spark, sf, slots)
    ref = StreamRefresher(
        spark, scratch_path(spark, "refresh"),
        config=config or RefreshConfig(P.WR_RANK, P.WR_ITER, P.WR_LAMBDA, P.TOP_N, refit_every),
    )
    ref.seed_history(ratings_b(spark, sf) if seed is None else seed)
    ref.replay(rep, scratch_path(spark, "replay"))
    rep.release()
    return ref


def q_stream_history(spark, sf):
    return _refresher(spark, sf, P.REPLAY_SLOTS, 0).history().select("user_id", "item_id", "rating")


def q_stream_round_log(spark, sf):
    return _refresher(spark, sf, P.REPLAY_SLOTS, 0).round_log().select("slot", "rows", "users")


def q_stream_refresh(spark, sf):
    ref = _refresher(spark, sf, P.REFRESH_SLOTS, 1)
    return ref.published().select("rowkey", F.col("recMovies").alias("rec_movies"))


def q_stream_refresh_exact(spark, sf):
    # Same refresh with the exact ALS as the model, so the result is checkable.
    cfg = RefreshConfig(
        P.EXACT_RANK, P.EXACT_EPOCHS, P.EXACT_LAMBDA, P.TOP_N, 1, P.EXACT_SEED, model="exact"
    )
    ref = _refresher(spark, sf, P.REFRESH_SLOTS, 1, cfg)
    return ref.published().select("rowkey", F.col("recMovies").alias("rec_movies"))


def _every2(spark, sf, seed: DataFrame | None = None) -> StreamRefresher:
    cfg = RefreshConfig(
        P.EXACT_RANK, P.EXACT_EPOCHS, P.EXACT_LAMBDA, P.TOP_N, 2, P.EXACT_SEED, model="exact"
    )
    return _refresher(spark, sf, P.REPLAY_SLOTS, 2, cfg, seed)


def q_stream_refresh_every2(spark, sf):
    # A refit every second batch publishes the users of both.
    ref = _every2(spark, sf)
    return ref.published().select("rowkey", F.col("recMovies").alias("rec_movies"))


def q_stream_unknown_users(spark, sf):
    # Stored ratings without the cold users: a batch between two refits meets users its model lacks.
    train, _ = _train_test(spark, sf)
    return _every2(spark, sf, train).batch_users().select(
        F.col("batch_id").cast("long").alias("round"), "user_id", "in_model")


def q_stream_refresh_certificate(spark, sf):
    # The lists of the last batch's users are the best of the model that the last refit left.
    ref = _refresher(spark, sf, P.REFRESH_SLOTS, 1)
    last = ref.batch_users().where(F.col("batch_id") == P.REFRESH_SLOTS - 1).select(F.col("user_id").cast("string").alias("rowkey"))
    users_f, items_f = ref.model()
    lists = ref.published().join(last, "rowkey", "left_semi")
    return check_top_n(spark, published_rows(lists, users_f, items_f, P.WR_RANK), users_f, items_f, P.WR_RANK, P.TOP_N)


def q_als_wr_certificate(spark, sf):
    # The library solves users last: their factors must solve their own normal equations.
    users, items = model_factors(_builtin_model(spark, sf))
    observed = ax.weighted(ratings_b(spark, sf))
    return ax.check_factors(observed, items, users, "item_id", "user_id", P.WR_RANK, P.WR_LAMBDA, "count")


def q_top_n_certificate(spark, sf):
    users, items = model_factors(_builtin_model(spark, sf))
    top = top_n_exact(spark, users, items, P.WR_RANK, P.TOP_N)
    return check_top_n(spark, top, users, items, P.WR_RANK, P.TOP_N)


def q_publish_recs_certificate(spark, sf):
    users, items = model_factors(_builtin_model(spark, sf))
    store = _publish_all(spark, users, items)
    lists = published_rows(store.read_wide("t_users", ["recMovies"]), users, items, P.WR_RANK)
    return check_top_n(spark, lists, users, items, P.WR_RANK, P.TOP_N)


def _publish_all(spark, users, items) -> KeyedStore:
    # Score every user against every item exactly (no pair rows), and
    # upsert one string per user.
    top = top_n_exact(spark, users, items, P.WR_RANK, P.TOP_N)
    store = _store(spark)
    store.put_columns("t_users", publish_strings(top), "user_id", {"recMovies": "rec_movies"})
    return store


def _builtin_model(spark, sf):
    rb = ratings_b(spark, sf)
    return fit_als(spark, rb, P.WR_RANK, P.WR_ITER, P.WR_LAMBDA)


def q_publish_recs(spark, sf):
    users, items = model_factors(_builtin_model(spark, sf))
    return _publish_all(spark, users, items).read_wide("t_users", ["recMovies"]).select(
        "rowkey", F.col("recMovies").alias("rec_movies")
    )


def q_publish_recs_exact(spark, sf):
    top = _top_exact_raw(spark, sf)
    store = _store(spark)
    store.put_columns("t_users", publish_strings(top), "user_id", {"recMovies": "rec_movies"})
    return store.read_wide("t_users", ["recMovies"]).select(
        "rowkey", F.col("recMovies").alias("rec_movies")
    )


# -- B: projections, filters, predicates --------------------------------------------
def q_to_tsv(spark, sf):
    return to_tsv(ratings_s(spark, sf))


def q_known_pairs(spark, sf):
    res = _exact(spark, sf, 1)
    _, test = _train_test(spark, sf)
    return known_pairs(spark, test, res.user_factors, res.item_factors, P.EXACT_RANK)


def q_nan_guard(spark, sf):
    train, _ = _train_test(spark, sf)
    items0 = ax.init_factors(train, "item_id", P.EXACT_RANK, P.EXACT_SEED)
    joined = ax.attach_factors(ax.weighted(train), items0, "item_id", P.EXACT_RANK)
    neq = nan_guard(ax.normal_equations(joined, "user_id", P.EXACT_RANK), ["ata", "atb"])
    return neq.agg(F.count(F.lit(1)).cast("long").alias("n_checked"))


# -- C, J: joins and model operators -------------------------------------------
def _neq_rows(neq: DataFrame, key: str) -> DataFrame:
    d = P.FACTOR_DIGITS
    return neq.select(
        key, "n",
        F.round(F.col("ata")[0], d).alias("a00"),
        F.round(F.col("ata")[1], d).alias("a01"),
        F.round(F.col("ata")[2], d).alias("a11"),
        F.round(F.col("atb")[0], d).alias("b0"),
        F.round(F.col("atb")[1], d).alias("b1"),
    )


def q_normal_eq_user(spark, sf):
    train, _ = _train_test(spark, sf)
    items0 = ax.init_factors(train, "item_id", P.EXACT_RANK, P.EXACT_SEED)
    joined = ax.attach_factors(ax.weighted(train), items0, "item_id", P.EXACT_RANK)
    return _neq_rows(ax.normal_equations(joined, "user_id", P.EXACT_RANK), "user_id")


def q_normal_eq_item(spark, sf):
    train, _ = _train_test(spark, sf)
    users0 = ax.init_factors(train, "user_id", P.EXACT_RANK, P.EXACT_SEED)
    joined = ax.attach_factors(ax.weighted(train), users0, "user_id", P.EXACT_RANK)
    return _neq_rows(ax.normal_equations(joined, "item_id", P.EXACT_RANK), "item_id")


def _first_user_step(spark, sf):
    train, _ = _train_test(spark, sf)
    items0 = ax.init_factors(train, "item_id", P.EXACT_RANK, P.EXACT_SEED)
    observed = ax.weighted(train)
    users1 = ax.half_step(observed, items0, "item_id", "user_id", P.EXACT_RANK, P.EXACT_LAMBDA)
    # Written, as its size is counted before the next step reads it.
    return observed, ax._write_read(spark, users1, scratch_path(spark, "users1"))


def q_als_half_step_user(spark, sf):
    _, users1 = _first_user_step(spark, sf)
    return _factor_rows(users1, "user_id")


def q_als_half_step_item(spark, sf):
    observed, users1 = _first_user_step(spark, sf)
    items1 = ax.half_step(observed, users1, "user_id", "item_id", P.EXACT_RANK, P.EXACT_LAMBDA)
    return _factor_rows(items1, "item_id")


def q_factor_update(spark, sf):
    _, users1 = _first_user_step(spark, sf)
    old = ax.init_factors(users_table(spark, sf), "user_id", P.EXACT_RANK, P.EXACT_SEED)
    return _factor_rows(ax.update_factors(old, users1), "user_id")


def q_factor_init(spark, sf):
    train, _ = _train_test(spark, sf)
    items0 = ax.init_factors(train, "item_id", P.EXACT_RANK, P.EXACT_SEED)
    return _factor_rows(items0, "item_id", P.INIT_DIGITS)


def _both_factor_rows(res: ax.ExactAlsResult) -> DataFrame:
    u = _factor_rows(res.user_factors, "id").select(F.lit("user").alias("entity"), "*")
    i = _factor_rows(res.item_factors, "id").select(F.lit("item").alias("entity"), "*")
    return u.unionByName(i)


def q_als_exact(spark, sf):
    return _both_factor_rows(_exact(spark, sf, P.EXACT_EPOCHS))


def q_als_count_weighted(spark, sf):
    # The library's convention (lambda * ratings of the entity), exactly.
    return _both_factor_rows(_exact(spark, sf, P.EXACT_EPOCHS, reg="count"))


def q_loss_history(spark, sf):
    res = _exact(spark, sf, P.EXACT_EPOCHS)
    d = P.RMSE_DIGITS
    return res.history.select(
        "epoch",
        F.round("train_rmse", d).alias("train_rmse"),
        F.round("test_rmse", d).alias("test_rmse"),
        "train_known",
        "test_known",
    )


def _rmse_rows(df: DataFrame) -> DataFrame:
    return df.select("n_all", "n_known", F.round("rmse", P.RMSE_DIGITS).alias("rmse"))


def q_rmse_train(spark, sf):
    res = _exact(spark, sf, 1)
    train, _ = _train_test(spark, sf)
    return _rmse_rows(rmse(train, res.user_factors, res.item_factors, P.EXACT_RANK))


def q_rmse_test(spark, sf):
    res = _exact(spark, sf, 1)
    _, test = _train_test(spark, sf)
    return _rmse_rows(rmse(test, res.user_factors, res.item_factors, P.EXACT_RANK))


def q_predict_pairs(spark, sf):
    res = _exact(spark, sf, 1)
    _, test = _train_test(spark, sf)
    p = predict_pairs(spark, test, res.user_factors, res.item_factors, P.EXACT_RANK)
    return p.select(
        "user_id", "item_id", "rating", F.round("prediction", P.FACTOR_DIGITS).alias("prediction")
    )


def _top_exact_raw(spark, sf):
    res = _exact(spark, sf, 1)
    return top_n_exact(spark, res.user_factors, res.item_factors, P.EXACT_RANK, P.TOP_N)


def q_top_n_exact(spark, sf):
    top = _top_exact_raw(spark, sf)
    return top.select(
        "user_id", "rank", "item_id", F.round("score", P.FACTOR_DIGITS).alias("score")
    )


def q_affected_users(spark, sf):
    train, _ = _train_test(spark, sf)
    model_users = ax.init_factors(train, "user_id", P.EXACT_RANK, P.EXACT_SEED)
    return affected_users(ratings_s(spark, sf), model_users)


def q_als_wr(spark, sf):
    users, items = model_factors(_builtin_model(spark, sf))
    u = users.select(F.lit("user").alias("entity"), "id", *vector_columns(F.col("features"), P.WR_RANK, "f", P.FACTOR_DIGITS))
    i = items.select(F.lit("item").alias("entity"), "id", *vector_columns(F.col("features"), P.WR_RANK, "f", P.FACTOR_DIGITS))
    return u.unionByName(i)


def q_top_n(spark, sf):
    # Top 10 of every user under the library model, scored by the exact
    # scorer (no user x item rows; the library's own path cross-joins blocks).
    users, items = model_factors(_builtin_model(spark, sf))
    top = top_n_exact(spark, users, items, P.WR_RANK, P.TOP_N)
    return top.select("user_id", "rank", "item_id", F.round("score", P.FACTOR_DIGITS).alias("score"))


# -- D, G: aggregations and sets -------------------------------------------------
def q_rating_profile(spark, sf):
    ratings = ratings_b(spark, sf).select("user_id", "item_id")
    return rating_profile(tag_split(ratings, P.SPLIT_TEST_MOD, P.SPLIT_COLD_MOD))


def q_entity_lists(spark, sf):
    train, _ = _train_test(spark, sf)
    return entity_lists(train)


def q_history_union(spark, sf):
    cols = ["user_id", "item_id", "rating"]
    return ratings_b(spark, sf).select(*cols).unionByName(ratings_s(spark, sf).select(*cols))


QUERIES: dict[str, Query] = {
    # A
    "scan_items": q_scan_items,
    "scan_ratings": q_scan_ratings,
    "scan_check": q_scan_check,
    "train_test_split": q_train_test_split,
    "ratings_typed": q_ratings_typed,
    "rating_cells_typed": q_rating_cells_typed,
    "load_train_test": q_load_train_test,
    "load_rejects": q_load_rejects,
    "kv_upsert": q_kv_upsert,
    "ratings_by_time": q_ratings_by_time,
    "store_keys": q_store_keys,
    "seed_users": q_seed_users,
    "stream_ratings": q_stream_ratings,
    "replay_batches": q_replay_batches,
    "publish_recs": q_publish_recs,
    "publish_recs_exact": q_publish_recs_exact,
    "publish_recs_certificate": q_publish_recs_certificate,
    # B
    "to_tsv": q_to_tsv,
    "known_pairs": q_known_pairs,
    "nan_guard": q_nan_guard,
    # C
    "als_half_step_user": q_als_half_step_user,
    "als_half_step_item": q_als_half_step_item,
    "predict_pairs": q_predict_pairs,
    "factor_update": q_factor_update,
    "top_n_exact": q_top_n_exact,
    "affected_users": q_affected_users,
    # D
    "rating_profile": q_rating_profile,
    "normal_eq_user": q_normal_eq_user,
    "normal_eq_item": q_normal_eq_item,
    "rmse_train": q_rmse_train,
    "rmse_test": q_rmse_test,
    # F
    "top_n": q_top_n,
    "top_n_certificate": q_top_n_certificate,
    # G
    "history_union": q_history_union,
    "entity_lists": q_entity_lists,
    # I
    "stream_history": q_stream_history,
    "stream_refresh": q_stream_refresh,
    "stream_refresh_exact": q_stream_refresh_exact,
    "stream_round_log": q_stream_round_log,
    "stream_refresh_every2": q_stream_refresh_every2,
    "stream_unknown_users": q_stream_unknown_users,
    "stream_refresh_certificate": q_stream_refresh_certificate,
    # J
    "als_wr": q_als_wr,
    "als_wr_certificate": q_als_wr_certificate,
    "als_exact": q_als_exact,
    "als_count_weighted": q_als_count_weighted,
    "factor_init": q_factor_init,
    "loss_history": q_loss_history,
}
