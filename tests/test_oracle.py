"""The oracle must notice a wrong rule, a missing check or a moved column."""

import duckdb
import pytest

import __spark_entry__ as E
from ballotbox import schemas
from ballotbox.functions import normalize
from ballotbox.operators import quality, staging
from ballotbox.plans import sqlrules
from test_entry import SF, TABLES, _bag


def agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return _bag(E.queries()[name](spark, SF).toArrow()) == _bag(con.sql(E.oracle_sql()[name]).to_arrow_table())


def test_layouts_and_rules_agree():
    assert set(sqlrules.MODELS) == set(schemas.FILE_TYPES)
    for ft in schemas.FILE_TYPES:
        assert [c for c, _ in sqlrules.columns(ft)] == schemas.column_names(ft)
        assert all(staging.rule_for(ft, c) == r for c, r in sqlrules.columns(ft))


@pytest.mark.parametrize("column,rule", [("transaction_dt", "pass"), ("zip_code", "trim"), ("name", "pass"), ("sub_id", "pass")])
def test_a_changed_rule_is_seen(spark, monkeypatch, column, rule):
    monkeypatch.setitem(staging.RULE_MAPS, "indiv", {**staging.RULE_MAPS["indiv"], column: rule})
    assert not agrees(spark, "stg_indiv")


def test_a_changed_cleaning_function_is_seen(spark, monkeypatch):
    monkeypatch.setitem(normalize.RULES, "zip5", normalize.trim_spaces)
    assert not agrees(spark, "stg_cm")


def test_a_missing_check_is_seen(spark, monkeypatch):
    monkeypatch.setitem(quality.NOT_NULL, "stg_cm", ("cmte_id", "cycle"))
    assert not agrees(spark, "qa_not_null")
