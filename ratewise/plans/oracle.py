"""DuckDB SQL that computes each registered query independently.

The exact-ALS checks are chained CTEs: every half step is a join, a
GROUP BY of the 2x2 normal equations and the closed-form 2x2 solve.
"""

from __future__ import annotations

from ratewise.functions.vectors import INIT_MODULUS, init_multipliers
from ratewise.plans import params as P

RB = """SELECT CAST(o_custkey AS INT) AS user_id,
       CAST(l_partkey AS INT) AS item_id,
       CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
       l_shipdate AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

RS = """SELECT CAST(user_id AS INT) AS user_id,
       CAST(json_extract_string(props, '$.k') AS INT) AS item_id,
       CAST(least(5, 1 + floor(value / 20)) AS DOUBLE) AS rating,
       ts, event_id, event_type
FROM events"""

TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _is_test(u: str = "user_id", i: str = "item_id") -> str:
    return (
        f"((CAST({u} AS BIGINT) * 31 + CAST({i} AS BIGINT) * 17) % {P.SPLIT_TEST_MOD} = 0"
        f" OR CAST({u} AS BIGINT) % {P.SPLIT_COLD_MOD} = 0)"
    )


def _init(col: str, k: int, seed: int = P.EXACT_SEED) -> str:
    m = init_multipliers(k + 1)[k]
    return (
        f"(CAST(((CAST({col} AS BIGINT) + 1) * {m} + {seed}) % {INIT_MODULUS} AS DOUBLE)"
        f" / CAST({INIT_MODULUS} AS DOUBLE) * CAST(2 AS DOUBLE) - CAST(1 AS DOUBLE))"
    )


def _base_ctes() -> list[str]:
    return [
        f"rb AS ({RB})",
        f"sp AS (SELECT user_id, item_id, rating, {_is_test()} AS is_test FROM rb)",
        "train AS (SELECT user_id, item_id, rating FROM sp WHERE NOT is_test)",
        "test AS (SELECT user_id, item_id, rating FROM sp WHERE is_test)",
        f"i0 AS (SELECT id, {_init('id', 0)} AS f0, {_init('id', 1)} AS f1"
        " FROM (SELECT DISTINCT item_id AS id FROM train))",
        f"u0 AS (SELECT id, {_init('id', 0)} AS f0, {_init('id', 1)} AS f1"
        " FROM (SELECT DISTINCT user_id AS id FROM train))",
    ]


def _neq(name: str, key: str, fixed: str, fixed_key: str, train: str = "train") -> str:
    return (
        f"{name} AS (SELECT t.{key} AS id, count(*) AS n,"
        " sum(v.f0 * v.f0) AS a00, sum(v.f0 * v.f1) AS a01, sum(v.f1 * v.f1) AS a11,"
        " sum(v.f0 * t.rating) AS b0, sum(v.f1 * t.rating) AS b1"
        f" FROM {train} t JOIN {fixed} v ON t.{fixed_key} = v.id GROUP BY t.{key})"
    )


def _chain(p: str, train: str, epochs: int) -> list[str]:
    """Exact ALS on ``train`` with CTE names prefixed by ``p``; ends in
    ``{p}u{epochs}`` and ``{p}i{epochs}``."""
    ctes = [
        f"{p}i0 AS (SELECT id, {_init('id', 0)} AS f0, {_init('id', 1)} AS f1"
        f" FROM (SELECT DISTINCT item_id AS id FROM {train}))"
    ]
    for e in range(1, epochs + 1):
        ctes.append(_neq(f"{p}nu{e}", "user_id", f"{p}i{e - 1}", "item_id", train))
        ctes.append(_solve(f"{p}u{e}", f"{p}nu{e}"))
        ctes.append(_neq(f"{p}ni{e}", "item_id", f"{p}u{e}", "user_id", train))
        ctes.append(_solve(f"{p}i{e}", f"{p}ni{e}"))
    return ctes


def _solve(name: str, neq: str, count: bool = False) -> str:
    lam = f"CAST({P.EXACT_LAMBDA} AS DOUBLE)"
    if count:
        lam = f"({lam} * n)"
    det = f"((a00 + {lam}) * (a11 + {lam}) - a01 * a01)"
    return (
        f"{name} AS (SELECT id, ((a11 + {lam}) * b0 - a01 * b1) / {det} AS f0,"
        f" ((a00 + {lam}) * b1 - a01 * b0) / {det} AS f1 FROM {neq})"
    )


def _als_ctes(epochs: int, count: bool = False) -> list[str]:
    ctes = _base_ctes()
    for e in range(1, epochs + 1):
        ctes.append(_neq(f"nu{e}", "user_id", f"i{e - 1}", "item_id"))
        ctes.append(_solve(f"u{e}", f"nu{e}", count))
        ctes.append(_neq(f"ni{e}", "item_id", f"u{e}", "user_id"))
        ctes.append(_solve(f"i{e}", f"ni{e}", count))
    return ctes


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _r(expr: str, digits: int) -> str:
    return f"round({expr}, {digits})"


def _sq_rows(src: str, tag: str, e: int) -> str:
    known = "(u.id IS NOT NULL AND v.id IS NOT NULL)"
    return (
        f"SELECT '{tag}' AS s, CASE WHEN {known} THEN pow(t.rating - (u.f0 * v.f0 + u.f1 * v.f1), 2)"
        f" ELSE 0 END AS sq, {known} AS known"
        f" FROM {src} t LEFT JOIN u{e} u ON t.user_id = u.id LEFT JOIN i{e} v ON t.item_id = v.id"
    )


def _split_rmse(tag: str) -> str:
    sse = f"sum(CASE WHEN s = '{tag}' THEN sq END)"
    n = f"count(CASE WHEN s = '{tag}' THEN 1 END)"
    return _r(f"sqrt({sse} / {n})", P.RMSE_DIGITS)


def _loss_history() -> str:
    ctes = _als_ctes(P.EXACT_EPOCHS)
    rows = []
    for e in range(1, P.EXACT_EPOCHS + 1):
        rows.append(
            f"SELECT {e - 1} AS epoch, {_split_rmse('train')} AS train_rmse,"
            f" {_split_rmse('test')} AS test_rmse,"
            " count(CASE WHEN s = 'train' AND known THEN 1 END) AS train_known,"
            " count(CASE WHEN s = 'test' AND known THEN 1 END) AS test_known"
            f" FROM ({_sq_rows('train', 'train', e)} UNION ALL {_sq_rows('test', 'test', e)})"
        )
    return _with(ctes, "\nUNION ALL\n".join(rows))


def _rmse(src: str) -> str:
    return _with(
        _als_ctes(1),
        "SELECT count(*) AS n_all, count(CASE WHEN known THEN 1 END) AS n_known,"
        f" {_r('sqrt(sum(sq) / count(*))', P.RMSE_DIGITS)} AS rmse"
        f" FROM ({_sq_rows(src, 'all', 1)})",
    )


def _factors(name: str, id_name: str, digits: int = P.FACTOR_DIGITS) -> str:
    return f"SELECT id AS {id_name}, {_r('f0', digits)} AS f0, {_r('f1', digits)} AS f1 FROM {name}"


def _neq_rows(name: str, key: str) -> str:
    d = P.FACTOR_DIGITS
    return (
        f"SELECT id AS {key}, n, {_r('a00', d)} AS a00, {_r('a01', d)} AS a01, {_r('a11', d)} AS a11,"
        f" {_r('b0', d)} AS b0, {_r('b1', d)} AS b1 FROM {name}"
    )


def _top_ctes() -> list[str]:
    return _als_ctes(1) + [
        "scored AS (SELECT u.id AS user_id, v.id AS item_id, u.f0 * v.f0 + u.f1 * v.f1 AS score"
        " FROM u1 u CROSS JOIN i1 v)",
        "ranked AS (SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id"
        f" ORDER BY round(score, 6) DESC, item_id) AS rank FROM scored)",
        f"top AS (SELECT * FROM ranked WHERE rank <= {P.TOP_N})",
    ]


def _slot(slots: int) -> str:
    return (
        f"CAST(least({slots - 1}, floor((epoch_us(ts) - lo) * {slots} / (hi - lo + 1))) AS INT)"
    )


def _slotted(slots: int) -> str:
    return (
        f"WITH rs AS ({RS}), b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM rs)\n"
        f"SELECT user_id, item_id, rating, {_slot(slots)} AS slot FROM rs, b"
    )


def _users_last_item() -> str:
    return (
        f"WITH rs AS ({RS}),\n"
        "last AS (SELECT user_id, item_id FROM (SELECT user_id, item_id, row_number() OVER"
        " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM rs WHERE item_id IS NOT NULL)"
        " WHERE rn = 1),\n"
        "keys AS (SELECT CAST(c_custkey AS INT) AS user_id FROM customer)\n"
    )


def _stream_refresh_exact(slots: int = P.REFRESH_SLOTS, every: int = 1) -> str:
    """Refits after every ``every``-th slot publish the users of the slots since the last."""
    e = P.EXACT_EPOCHS
    ctes = [
        f"rb AS ({RB})",
        f"rs0 AS ({RS}), b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM rs0)",
        f"rs AS (SELECT user_id, item_id, rating, {_slot(slots)} AS slot FROM rs0, b)",
    ]
    pubs = []
    for k in range(every - 1, slots, every):
        p = f"s{k}_"
        ctes.append(
            f"{p}train AS (SELECT user_id, item_id, rating FROM rb"
            f" UNION ALL SELECT user_id, item_id, rating FROM rs WHERE slot <= {k})"
        )
        ctes += _chain(p, f"{p}train", e)
        ctes.append(
            f"{p}top AS (SELECT * FROM (SELECT u.id AS user_id, v.id AS item_id,"
            " u.f0 * v.f0 + u.f1 * v.f1 AS score, row_number() OVER (PARTITION BY u.id"
            " ORDER BY round(u.f0 * v.f0 + u.f1 * v.f1, 6) DESC, v.id) AS rank"
            f" FROM {p}u{e} u CROSS JOIN {p}i{e} v"
            f" WHERE u.id IN (SELECT user_id FROM rs WHERE slot BETWEEN {k - every + 1} AND {k}))"
            f" WHERE rank <= {P.TOP_N})"
        )
        pubs.append(
            f"SELECT {k} AS slot, user_id, string_agg(CAST(item_id AS VARCHAR) || ':' ||"
            " substr(CAST(score AS VARCHAR), 1, 4), ',' ORDER BY rank) AS rec_movies"
            f" FROM {p}top GROUP BY user_id"
        )
    ctes.append("pub AS (" + " UNION ALL ".join(pubs) + ")")
    return _with(
        ctes,
        "SELECT CAST(user_id AS VARCHAR) AS rowkey, arg_max(rec_movies, slot) AS rec_movies"
        " FROM pub GROUP BY user_id",
    )


def _stream_unknown_users() -> str:
    """With a refit after every second slot: no model in slot 0, after that that of the last odd slot."""
    return (
        f"WITH rb AS ({RB}), rs0 AS ({RS}), b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM rs0),\n"
        f"rs AS (SELECT user_id, {_slot(P.REPLAY_SLOTS)} AS slot FROM rs0, b),\n"
        f"first AS (SELECT user_id, min(slot) AS slot FROM (SELECT user_id, slot FROM rs UNION ALL SELECT user_id, -1 FROM rb WHERE NOT {_is_test()}) GROUP BY user_id)\n"
        "SELECT CAST(r.slot AS BIGINT) AS round, r.user_id, f.slot <= (r.slot + 1) // 2 * 2 - 1 AND r.slot >= 1 AS in_model\n"
        "FROM (SELECT DISTINCT user_id, slot FROM rs) r JOIN first f USING (user_id)"
    )


def _optimal(users: str) -> str:
    """Every user's list is as long as it can be, in order and optimal."""
    return (
        f"WITH rb AS ({RB}), rs0 AS ({RS})\n"
        f"SELECT DISTINCT user_id, CAST(least({P.TOP_N}, (SELECT count(DISTINCT item_id) FROM {{items}})) AS INT) AS n_items,"
        f" TRUE AS ordered, TRUE AS optimal FROM {users}"
    )


ORACLE: dict[str, str] = {
    # A
    "scan_items": "SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS name,"
    " CAST(p_retailprice AS VARCHAR) AS price FROM part",
    "scan_ratings": f"WITH rb AS ({RB}) SELECT CAST(user_id AS VARCHAR) AS user,"
    " CAST(item_id AS VARCHAR) AS movie, CAST(rating AS VARCHAR) AS rating,"
    f" {TS_TEXT.format(c='ts')} AS time FROM rb",
    "scan_check": f"WITH rb AS ({RB}), rs AS ({RS})"
    " SELECT (SELECT count(*) FROM rb) + (SELECT count(*) FROM rs) AS n_lines,"
    " (SELECT count(*) FROM rb) AS n_good, (SELECT count(*) FROM rs) AS n_bad",
    "train_test_split": f"WITH rb AS ({RB}) SELECT user_id, item_id, rating, ts,"
    f" CASE WHEN {_is_test()} THEN 'test' ELSE 'train' END AS split FROM rb",
    "ratings_typed": f"SELECT user_id, item_id, rating FROM ({RB})",
    "rating_cells_typed": f"WITH rb AS ({RB}), r AS (SELECT *, row_number() OVER (PARTITION BY ts"
    " ORDER BY user_id DESC, item_id DESC, rating DESC) AS rn FROM rb)"
    f" SELECT {TS_TEXT.format(c='ts')} AS rowkey, user_id, item_id, rating FROM r WHERE rn = 1",
    "load_train_test": f"WITH rb AS ({RB}) SELECT user_id, item_id, rating,"
    f" CASE WHEN {_is_test()} THEN 'test' ELSE 'train' END AS split FROM rb",
    "load_rejects": f"SELECT 'test' AS file, event_type AS first, CAST(item_id AS VARCHAR) AS second,"
    f" CAST(rating AS VARCHAR) AS third FROM ({RS})"
    " UNION ALL SELECT 'items', CAST(p_partkey AS VARCHAR), NULL, CAST(p_retailprice AS VARCHAR) FROM part",
    "kv_upsert": _users_last_item()
    + "SELECT CAST(coalesce(k.user_id, l.user_id) AS VARCHAR) AS rowkey,"
    " CAST(k.user_id AS VARCHAR) AS uid, CAST(l.item_id AS VARCHAR) AS last_item"
    " FROM keys k FULL OUTER JOIN last l ON k.user_id = l.user_id",
    "store_keys": _users_last_item()
    + "SELECT CAST(user_id AS VARCHAR) AS rowkey FROM keys UNION SELECT CAST(user_id AS VARCHAR) FROM last",
    "seed_users": "SELECT CAST(c_custkey AS VARCHAR) AS rowkey, CAST(c_custkey AS VARCHAR) AS uid"
    " FROM customer",
    "ratings_by_time": f"WITH rb AS ({RB}), r AS (SELECT *, row_number() OVER (PARTITION BY ts"
    " ORDER BY user_id DESC, item_id DESC, rating DESC) AS rn FROM rb)"
    f" SELECT {TS_TEXT.format(c='ts')} AS rowkey, CAST(user_id AS VARCHAR) AS userId,"
    " CAST(item_id AS VARCHAR) AS movieId, CAST(rating AS VARCHAR) AS rating FROM r WHERE rn = 1",
    "stream_ratings": f"SELECT user_id, item_id, rating FROM ({RS})",
    "replay_batches": _slotted(P.REPLAY_SLOTS),
    "publish_recs_exact": _with(
        _top_ctes(),
        "SELECT CAST(user_id AS VARCHAR) AS rowkey, string_agg(CAST(item_id AS VARCHAR) || ':' ||"
        " substr(CAST(score AS VARCHAR), 1, 4), ',' ORDER BY rank) AS rec_movies"
        " FROM top GROUP BY user_id",
    ),
    # B
    "to_tsv": f"SELECT concat_ws(chr(9), CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR),"
    f" CAST(rating AS VARCHAR)) AS line FROM ({RS})",
    "known_pairs": _with(
        _als_ctes(1),
        "SELECT user_id, item_id, rating FROM test t"
        " WHERE user_id IN (SELECT id FROM u1) AND item_id IN (SELECT id FROM i1)",
    ),
    "nan_guard": _with(_base_ctes(), "SELECT count(DISTINCT user_id) AS n_checked FROM train"),
    # C
    "als_half_step_user": _with(_als_ctes(1), _factors("u1", "user_id")),
    "als_half_step_item": _with(_als_ctes(1), _factors("i1", "item_id")),
    "predict_pairs": _with(
        _als_ctes(1),
        "SELECT t.user_id, t.item_id, t.rating,"
        f" {_r('u.f0 * v.f0 + u.f1 * v.f1', P.FACTOR_DIGITS)} AS prediction"
        " FROM test t JOIN u1 u ON t.user_id = u.id JOIN i1 v ON t.item_id = v.id",
    ),
    "factor_update": _with(
        _als_ctes(1)
        + [
            f"old AS (SELECT CAST(c_custkey AS INT) AS id, {_init('c_custkey', 0)} AS f0,"
            f" {_init('c_custkey', 1)} AS f1 FROM customer)",
            "upd AS (SELECT o.id, coalesce(n.f0, o.f0) AS f0, coalesce(n.f1, o.f1) AS f1"
            " FROM old o LEFT JOIN u1 n ON o.id = n.id)",
        ],
        _factors("upd", "user_id"),
    ),
    "top_n_exact": _with(
        _top_ctes(),
        f"SELECT user_id, CAST(rank AS INT) AS rank, item_id, {_r('score', P.FACTOR_DIGITS)} AS score FROM top",
    ),
    "affected_users": _with(
        _base_ctes() + [f"rs AS ({RS})"],
        "SELECT DISTINCT user_id, user_id IN (SELECT id FROM u0) AS in_model FROM rs",
    ),
    # D
    "rating_profile": f"WITH rb AS ({RB}), sp AS (SELECT *, {_is_test()} AS is_test FROM rb)"
    " SELECT count(*) FILTER (WHERE NOT is_test) AS n_train, count(*) FILTER (WHERE is_test) AS n_test,"
    " count(DISTINCT user_id) FILTER (WHERE NOT is_test) AS n_users,"
    " count(DISTINCT item_id) FILTER (WHERE NOT is_test) AS n_items FROM sp",
    "normal_eq_user": _with(_base_ctes() + [_neq("nu", "user_id", "i0", "item_id")], _neq_rows("nu", "user_id")),
    "normal_eq_item": _with(_base_ctes() + [_neq("ni", "item_id", "u0", "user_id")], _neq_rows("ni", "item_id")),
    "rmse_train": _rmse("train"),
    "rmse_test": _rmse("test"),
    # G
    "history_union": f"SELECT user_id, item_id, rating FROM ({RB})"
    f" UNION ALL SELECT user_id, item_id, rating FROM ({RS})",
    "entity_lists": _with(
        _base_ctes(),
        "SELECT DISTINCT 'user' AS entity, user_id AS id FROM train"
        " UNION ALL SELECT DISTINCT 'item' AS entity, item_id AS id FROM train",
    ),
    # I
    "stream_history": f"SELECT user_id, item_id, rating FROM ({RB})"
    f" UNION ALL SELECT user_id, item_id, rating FROM ({RS})",
    "stream_refresh_exact": _stream_refresh_exact(),
    "stream_refresh_every2": _stream_refresh_exact(P.REPLAY_SLOTS, 2),
    "stream_unknown_users": _stream_unknown_users(),
    "stream_refresh_certificate": _optimal(
        f"(SELECT user_id, {_slot(P.REFRESH_SLOTS)} AS slot FROM rs0,"
        " (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM rs0))"
        f" WHERE slot = {P.REFRESH_SLOTS - 1}"
    ).format(items="(SELECT item_id FROM rb UNION ALL SELECT item_id FROM rs0)"),
    "als_wr_certificate": f"SELECT user_id AS id, count(*) AS n, TRUE AS solved FROM ({RB}) GROUP BY user_id",
    "top_n_certificate": _optimal("rb").format(items="rb"),
    "publish_recs_certificate": _optimal("rb").format(items="rb"),
    "stream_round_log": f"WITH s AS ({_slotted(P.REPLAY_SLOTS)})"
    " SELECT slot, count(*) AS rows, count(DISTINCT user_id) AS users FROM s GROUP BY slot",
    # J
    "als_exact": _with(
        _als_ctes(P.EXACT_EPOCHS),
        f"SELECT 'user' AS entity, * FROM ({_factors(f'u{P.EXACT_EPOCHS}', 'id')})"
        f" UNION ALL SELECT 'item' AS entity, * FROM ({_factors(f'i{P.EXACT_EPOCHS}', 'id')})",
    ),
    "als_count_weighted": _with(
        _als_ctes(P.EXACT_EPOCHS, count=True),
        f"SELECT 'user' AS entity, * FROM ({_factors(f'u{P.EXACT_EPOCHS}', 'id')})"
        f" UNION ALL SELECT 'item' AS entity, * FROM ({_factors(f'i{P.EXACT_EPOCHS}', 'id')})",
    ),
    "factor_init": _with(_base_ctes(), _factors("i0", "item_id", P.INIT_DIGITS)),
    "loss_history": _loss_history(),
}
