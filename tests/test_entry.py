import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["key", "summary", "current_status", "issue_type", "assignee"]


def test_every_query_has_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_matches_small_sf(spark):
    import duckdb
    from tools_check import compare
    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in ["customer", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    failed = [name for name in E.QUERIES if not compare(spark, con, name, sf)]
    assert failed == []


def test_every_oracle_can_be_a_view():
    import os

    import duckdb
    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf}/{t}')")
    for n, sql in enumerate(E.oracle_sql().values()):
        con.execute(f"CREATE VIEW o{n} AS {sql}")
        con.execute(f"SELECT count(*) FROM o{n}")
