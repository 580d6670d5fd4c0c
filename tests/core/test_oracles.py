"""Every registered query with an oracle, against DuckDB."""

import duckdb
import pytest

from quernstone.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    res = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    want = sorted((tuple(r) for r in res.fetchall()), key=repr)
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want) if g != w and not all(a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) < 2e-6) for a, b in zip(g, w))]
    assert not bad, bad[:3]


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
