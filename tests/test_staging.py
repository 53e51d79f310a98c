"""Staging on the four sample filings (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ballotbox import schemas
from ballotbox.operators import staging

SAMPLE = [
    # cmte_id, amndt_ind, zip_code, transaction_dt, transaction_amt, tran_id, memo_cd
    ("C00123456", "N", "10001", "01152024", "500.00", "SA11AI.1000", ""),
    ("C00789012", "N", "94102-5678", "02202024", "1000.00", "SA11AI.1001", "X"),
    ("C00345678", "A", "60601", "03102024", "250.50", "SA11AII.1000", ""),
    ("C00901234", "N", "75201", "04052024", "2700.00", "SA11AI.1002", ""),
]


def sample_raw(spark):
    cols = schemas.column_names("indiv")
    rows = []
    for cmte, amnd, zip_code, date, amt, tran, memo in SAMPLE:
        r = {c: "" for c in cols}
        r.update(cmte_id=cmte, amndt_ind=amnd, zip_code=zip_code, transaction_dt=date,
                 transaction_amt=amt, tran_id=tran, memo_cd=memo, name=" DOE, JANE ", sub_id=" 42 ")
        rows.append(tuple(r[c] for c in cols) + (2024,))
    return spark.createDataFrame(rows, schemas.raw_schema("indiv").add("cycle", IntegerType()))


def test_stage_indiv_sample(spark):
    out = staging.stage(sample_raw(spark), "indiv").orderBy("tran_id").collect()
    got = {r.tran_id: (r.zip_code, r.transaction_dt, r.transaction_amt, r.memo_cd, r.cycle) for r in out}
    assert got["SA11AI.1000"] == ("10001", dt.date(2024, 1, 15), Decimal("500.00"), "", 2024)
    assert got["SA11AI.1001"] == ("94102", dt.date(2024, 2, 20), Decimal("1000.00"), "X", 2024)
    assert got["SA11AII.1000"] == ("60601", dt.date(2024, 3, 10), Decimal("250.50"), "", 2024)
    assert got["SA11AI.1002"] == ("75201", dt.date(2024, 4, 5), Decimal("2700.00"), "", 2024)
    assert all(r.name == "DOE, JANE" and r.sub_id == 42 for r in out)


def test_stage_types_and_names(spark):
    df = staging.stage(sample_raw(spark), "indiv")
    assert df.columns == schemas.column_names("indiv") + ["cycle"]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["transaction_amt"] == "decimal(14,2)"
    assert types["transaction_dt"] == "date"
    assert types["file_num"] == "bigint" and types["cycle"] == "int"


def test_strict_nulls_blank_text(spark):
    r = staging.stage(sample_raw(spark), "indiv", strict=True).where("tran_id = 'SA11AI.1000'").first()
    assert r.memo_cd is None and r.occupation is None


def test_pass_through_models_keep_text(spark):
    cols = schemas.column_names("oth")
    row = {c: "" for c in cols}
    row.update(zip_code=" 94102-5678 ", name=" ACME ", transaction_amt=" 12.345 ", transaction_dt="01152024")
    df = spark.createDataFrame([tuple(row[c] for c in cols) + (2020,)], schemas.raw_schema("oth").add("cycle", IntegerType()))
    r = staging.stage(df, "oth").first()
    assert r.zip_code == " 94102-5678 " and r.name == " ACME "
    assert r.transaction_amt == Decimal("12.35") and r.transaction_dt == dt.date(2024, 1, 15)


def test_rename_aliases(spark):
    df = staging.rename_to_aliases(staging.stage(sample_raw(spark), "indiv"), "indiv")
    assert "committee_id" in df.columns and "cycle" in df.columns and "cmte_id" not in df.columns


def test_http_source_drops_text(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00", "u", 200, "héllo")],
                               "fetched_at string, url string, status_code int, content string")
    r = staging.stage_http_source(df).first()
    assert r.preview_length == 5 and "content_preview" not in r.asDict()


def test_materialized_staging_pushes_filters(spark, scratch):
    path = scratch("typed")
    staging.materialize(sample_raw(spark), "indiv", path)
    df = spark.read.parquet(path).where("transaction_amt > 600 and cycle = 2024")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(transaction_amt), GreaterThan(transaction_amt,600" in plan
    assert "PartitionFilters: [isnotnull(cycle" in plan
    assert sorted(r.tran_id for r in df.collect()) == ["SA11AI.1001", "SA11AI.1002"]


def _star(spark, buckets=4):
    from ballotbox.operators import marts

    day = dt.date(2024, 1, 1)
    indiv = spark.createDataFrame(
        [(f"C{i % 7}" if i % 3 else "C0", 2020 + 2 * (i % 2), Decimal("1.10") * (i % 5), day + dt.timedelta(days=i % 4) if i % 6 else None)
         for i in range(400)] + [(None, None, Decimal("3.00"), None)],
        "cmte_id string, cycle int, transaction_amt decimal(14,2), transaction_dt date")
    cm = spark.createDataFrame([(f"C{i}", 2020, f"N{i}", "H") for i in range(5)] + [("C1", 2020, "M", "S"), ("C1", 2022, "X", None)],
                               "cmte_id string, cycle int, cmte_nm string, cmte_tp string")
    ccl = spark.createDataFrame([("H1", "C0", 2020), ("H1", "C0", 2020), ("H1", "C1", 2022), ("H2", "C1", 2022), ("H3", "C9", 2020)],
                                "cand_id string, cmte_id string, cycle int")
    return indiv, ccl, marts.store_star(indiv, cm, ccl, buckets)


def test_star_joins_without_an_exchange(spark):
    from ballotbox.operators import marts

    indiv, ccl, stored = _star(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = marts.linked_totals(*stored)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        got = {(r.cand_id, r.cmte_id, r.cycle): (r.n_contributions, r.total_amt, r.first_dt, r.cmte_nm) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    rows = indiv.collect()
    for (cand, cmte, cycle), (n, amt, first, name) in got.items():
        mine = [r for r in rows if (r.cmte_id, r.cycle) == (cmte, cycle)]
        assert (n, amt) == (len(mine), sum(r.transaction_amt for r in mine))
        assert first == min(r.transaction_dt for r in mine if r.transaction_dt)
        assert name == {("C0", 2020): "N0", ("C1", 2022): "X"}[cmte, cycle]
    assert set(got) == {("H1", "C0", 2020), ("H1", "C1", 2022), ("H2", "C1", 2022)}
    # a hot committee has a row per day in its bucket
    assert stored[0].where("cmte_id = 'C0'").count() <= 2 * 5


def test_rollup_tells_missing_keys_from_subtotals(spark):
    from ballotbox.operators import marts

    receipts = spark.createDataFrame([("H1", 2020, Decimal("5.00")), ("H2", 2020, Decimal("7.00")), ("H9", 2022, Decimal("1.00"))],
                                     "cand_id string, cycle int, total_receipts decimal(38,2)")
    cn = spark.createDataFrame([("H1", 2020, "DEM", "H"), ("H2", 2020, "DEM", None)], "cand_id string, cycle int, cand_pty_affiliation string, cand_office string")
    got = {(r.all_party, r.party, r.all_office, r.office, r.all_cycle, r.cycle): (r.n_candidates, int(r.total_receipts))
           for r in marts.receipts_rollup(receipts, cn).collect()}
    assert got[1, None, 1, None, 1, None] == (3, 13)
    assert got[0, None, 1, None, 1, None] == (1, 1)             # no record: a party of its own
    assert got[0, "DEM", 0, None, 1, None] == (1, 7) and got[0, "DEM", 1, None, 1, None] == (2, 12)
    assert got[1, None, 1, None, 0, 2020] == (2, 12) and len(got) == 3 + 2 + 3 + 2 + 2 + 1


def test_wide_raw_rows_are_not_one_method(spark):
    # One generated method of all columns is too long for the JVM to compile.
    from ballotbox.plans import standins

    raw = standins.raw(spark, "/root/testdata/sf0.001", "indexp")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    top = next(line for line in plan.splitlines() if "Project" in line)
    assert "*(" not in top, top


def test_raw_rows_are_sorted_before_they_are_wide(spark):
    from ballotbox.plans import standins

    raw = standins.raw(spark, "/root/testdata/sf0.001", "pas2", by_cycle=True)
    plan = raw._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Project"
    assert [o.toString().split(" ")[0].split("#")[0] for o in _seq(plan.outputOrdering())] == ["cycle"]


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def test_upper_case_by_ascii_letters(spark):
    from ballotbox.plans import standins

    t = spark.createDataFrame([(x,) for x in ["a", "1-urgent", "ß", "éa", "", None, "x\ty", "zZ~"]], "t string")
    assert t.select(F.expr("upper(t)").alias("a"), standins._column("upper(t)", "b")).where("NOT (a <=> b)").count() == 0
