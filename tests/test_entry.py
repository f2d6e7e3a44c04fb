"""Driver contract: entry(), queries() and oracle_sql()."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "runs" in df.columns


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 50


def test_oracle_sql_runs_on_duckdb(sf):
    from pathlib import Path

    import duckdb
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    for k, sql in E.oracle_sql().items():
        con.execute(f"SELECT count(*) FROM ({sql}) AS q").fetchall()
