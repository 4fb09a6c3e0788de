"""Every registered query against its DuckDB oracle on sf0.001 (whole tables)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):  # exact comparison: both sides round similarities to 9 decimals themselves
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


QUERIES, SQL = entry._reference_queries(), entry._reference_sql()


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    res = con.execute(SQL[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["query", "rank", "term", "similarity"]
    assert df.count() > 0
