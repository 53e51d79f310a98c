"""Cleaning rules on the edge rows of FIXTURES.md section 3."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ballotbox.functions import normalize as N


def one_col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]


def test_trim_spaces_only(spark):
    assert one_col(spark, ["\t a ", "  ", None], N.trim_spaces) == ["\t a", "", None]


def test_zip5(spark):
    assert one_col(spark, ["  94102-5678", None, "  ", "10001"], N.zip5) == ["94102", None, "", "10001"]


def test_blank_to_null(spark):
    assert one_col(spark, ["  ", "", " x ", None], N.blank_to_null) == [None, None, "x", None]


def test_amount(spark):
    got = one_col(spark, ["12.345", "-12.345", "1e3", "1,000", "999999999999999", "  ", "500.00"], N.amount)
    assert got == [Decimal("12.35"), Decimal("-12.35"), Decimal("1000.00"), None, None, None, Decimal("500.00")]


def test_amount_rounded_keeps_width(spark):
    df = spark.createDataFrame([("12.345",)], "v string").select(N.amount("v", rounded=True).alias("a"))
    assert df.schema["a"].dataType.simpleString() == "decimal(14,2)"
    assert df.first().a == Decimal("12.35")


def test_bigint(spark):
    assert one_col(spark, [" 12 ", "12abc", "12.5", ""], N.to_bigint) == [12, None, None, None]


def test_year(spark):
    assert one_col(spark, ["2024", " 2022 ", "99999", "24", ""], N.year4) == [2024, 2022, None, None, None]


def test_date_mmddyyyy(spark):
    got = one_col(spark, ["01152024", "13152024", "02302024", "1152024", "011520241", " 01152024 "],
                  N.date_mmddyyyy)
    assert got == [dt.date(2024, 1, 15), None, None, None, None, dt.date(2024, 1, 15)]


def test_date_two_formats(spark):
    got = one_col(spark, ["01/15/2024", "1/15/2024", "01152024", "1/5/24"], N.date_two_formats)
    assert got == [dt.date(2024, 1, 15)] * 3 + [None]


def test_text_length_counts_characters(spark):
    assert one_col(spark, ["héllo", ""], N.text_length) == [5, 0]


def test_cycle_and_source_url(spark):
    df = spark.createDataFrame([(dt.date(2023, 5, 1), "indiv")], "d date, ft string")
    r = df.select(N.cycle_of("d").alias("c")).first()
    assert r.c == 2024
    url = df.select(N.source_url("ft", F.lit(2024)).alias("u")).first().u
    assert url.endswith("/2024/indiv24.zip")


def test_local_date(spark):
    df = spark.createDataFrame([("2024-01-02 03:00:00",)], "s string").select(
        N.local_date(F.to_timestamp_ntz("s")).alias("d"))
    assert df.first().d == dt.date(2024, 1, 1)


@pytest.mark.parametrize("rule", ["trim", "zip5", "amount", "bigint", "year", "date", "date2", "percent"])
def test_rules_keep_null(spark, rule):
    assert one_col(spark, [None], lambda c: N.apply_rule(rule, c)) == [None]


def test_time_functions_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("2024-01-02 03:00:00.000007",)], "s string").select(
                F.to_timestamp_ntz("s").alias("t"))
            r = df.select(N.local_date("t").alias("d"), N.epoch_micros("t").alias("us"),
                          N.from_epoch_micros(N.epoch_micros("t")).alias("back"), "t").first()
            assert r.d == dt.date(2024, 1, 1), zone
            assert r.us == 1704164400000007, zone
            assert r.back == r.t, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_date_of_every_text_as_try_to_date(spark):
    texts = ["01152024", "02292024", "02292023", "02302024", "04312024", "13152024", "00152024", "01150000", "1152024",
             "0115+20240", "0115-2024", "011520241", "01152024\n", "N/A", "2/29/2024", "2/29/2023", "13/1/2024", "1/5/24", None]
    plain = one_col(spark, texts, lambda c: F.try_to_date(N.blank_to_null(c), N.DATE_PLAIN).cast("string"))
    slash = one_col(spark, texts, lambda c: F.try_to_date(N.blank_to_null(c), N.DATE_SLASH).cast("string"))
    assert one_col(spark, texts, lambda c: N.date_mmddyyyy(c).cast("string")) == plain
    assert one_col(spark, texts, lambda c: N.date_two_formats(c).cast("string")) == [a or b for a, b in zip(slash, plain)]


def test_bad_texts_make_no_failing_cast(spark):
    # A failing cast or parse makes an error message first, whose cost was most of a staging model's time.
    df = spark.createDataFrame([("x",)], "v string").select(N.to_bigint("v").alias("n"), N.date_mmddyyyy("v").alias("d"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE(" in plan or "rlike" in plan.lower()
    assert one_col(spark, ["12abc", "1,2", "+12", "-12", "\t12", "12\n"], N.to_bigint) == [None, None, 12, -12, 12, 12]
