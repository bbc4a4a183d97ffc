import os

import duckdb

import __spark_entry__ as E
from sf_paths import SF_SMALL

QUICK = ["rating_profile", "train_test_split", "entity_lists", "history_union", "to_tsv",
         "factor_init", "normal_eq_user", "als_half_step_user", "affected_users"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["rowkey", "rec_movies"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_quick_queries_match_sql(spark):
    con = duckdb.connect()
    for t in ["lineitem", "orders", "events", "customer", "part"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    for name in QUICK:
        got = E.queries()[name](spark, SF_SMALL).toPandas()
        exp = con.execute(E.oracle_sql()[name]).df()
        cols = sorted(got.columns)
        assert cols == sorted(exp.columns), name
        g = sorted(map(tuple, got[cols].astype(str).values.tolist()))
        e = sorted(map(tuple, exp[cols].astype(str).values.tolist()))
        assert g == e, name
