"""Compares a registered query with its DuckDB SQL."""

import duckdb

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(spark, name, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    return cols, sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def oracle_rows(name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    cols = sorted(names)
    return cols, sorted((tuple(r[names.index(c)] for c in cols) for r in res.fetchall()), key=repr)


def assert_matches(spark, name, sf_dir):
    got, want = rows_of(spark, name, sf_dir), oracle_rows(name, sf_dir)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    for g, w in zip(got[1], want[1]):
        assert g == w
