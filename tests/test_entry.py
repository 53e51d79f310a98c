"""Driver contract, and every query against its DuckDB oracle at sf0.001."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"cmte_id", "cycle", "total_amt"} <= set(df.columns)


def test_oracles_are_for_registered_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _bag(table):
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return names, collections.Counter(tuple(_norm(c[i]) for c in cols) for i in range(table.num_rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toArrow()
    want = duck.sql(E.oracle_sql()[name]).to_arrow_table()
    assert _bag(got) == _bag(want)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
