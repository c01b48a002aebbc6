"""Every catalogue query against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from cofi.plans.catalog import ORACLE_SQL, QUERIES
from cofi.session import table_scope

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 6) + 0.0 if isinstance(v, float) and not math.isnan(v) else v
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    q, s = QUERIES, ORACLE_SQL
    assert set(s) | {"report_run"} == set(q) and set(q) <= set(entry.queries()) and set(s) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["method", "mae"] and df.count() == 4


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, duck, name):
    with table_scope(spark):
        df = QUERIES[name](spark, SF)
        rel = duck.sql(ORACLE_SQL[name])
        assert _canon(df.columns, df.collect()) == _canon(rel.columns, rel.fetchall())
