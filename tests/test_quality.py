"""Quality checks on small frames."""

import os

from pyspark.sql import functions as F

from ballotbox.operators import quality as Q
from ballotbox.plans import q_quality
from helpers import local_path


def test_declared_check_counts():
    n = sum(len(Q.declared_checks(m)) for m in Q.MODELS)
    kinds = [c.kind for m in Q.MODELS for c in Q.declared_checks(m)]
    assert kinds.count("not_null") == 34 and kinds.count("unique") == 3
    assert kinds.count("accepted_values") == 1 and kinds.count("expression_is_true") == 6 and n == 44


def test_run_checks_report(spark):
    df = spark.createDataFrame(
        [("C1", "T1", None, 2024, "12345"), ("C1", "T1", "x", 1998, "123456"), (None, "T2", "y", None, None)],
        "cmte_id string, tran_id string, v string, cycle int, zip_code string")
    checks = [Q.Check("not_null", "cmte_id"), Q.Check("not_null", "cycle"), Q.Check("unique", "tran_id"),
              Q.Check("accepted_values", "cycle", (2024, 2022)), Q.Check("expression_is_true", "zip_code")]
    got = {(r.check_name, r.column_name): r.failures for r in Q.run_checks(df, "m", checks).collect()}
    assert got == {("not_null", "cmte_id"): 1, ("not_null", "cycle"): 1, ("unique", "tran_id"): 1,
                   ("accepted_values", "cycle"): 1, ("expression_is_true", "zip_code"): 1}


def test_unique_by_cycle(spark):
    df = spark.createDataFrame([("C1", 2020), ("C1", 2022), ("C2", 2022), ("C2", 2022)], "cmte_id string, cycle int")
    assert Q.duplicate_values(df, "cmte_id").count() == 2
    assert [r.cmte_id for r in Q.duplicate_values(df, "cmte_id", by=("cycle",)).collect()] == ["C2"]


def test_orphans_and_amendments(spark):
    links = spark.createDataFrame([("H1", "C1"), ("H2", "C1"), ("H3", "C9")], "cand_id string, cmte_id string")
    cands = spark.createDataFrame([("H1",), ("H3",), ("H3",)], "cand_id string")
    assert [r.cand_id for r in Q.orphans(links, cands, "cand_id").collect()] == ["H2"]
    rows = spark.createDataFrame([("T1", "N"), ("T1", "A"), ("T1", "A"), ("T2", "N"), (None, "N")],
                                 "tran_id string, amndt_ind string")
    got = [(r.tran_id, r.n_rows, r.amendment_codes) for r in Q.amendment_duplicates(rows).collect()]
    assert got == [("T1", 3, "A,N")]


def test_row_widths_looks_layouts_up_after_counting(spark):
    lines = spark.createDataFrame([("a", "1|2"), ("a", "é|ü"), ("a", "1"), ("b", ""), ("b", None), ("c", "1|2|3")], "file_type string, value string")
    out = Q.row_widths(lines, {"a": 2, "b": 1})
    assert {tuple(r) for r in out.collect()} == {("a", 2, 3, 1, 1, 2), ("b", 1, 2, 0, 1, 1), ("c", None, 1, 0, 3, 3)}
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Aggregate" in line for line in plan) == 2


def test_lines_of_file_types_do_not_pile_up(spark, monkeypatch):
    held, plain, roots = [], [], set()

    def files(root):
        return [os.path.join(d, n) for d, _, names in os.walk(root) for n in names if ".txt" in n and n.startswith("part-")]

    def write(lines, path, **kw):
        real(lines, path, **kw)
        roots.add(os.path.dirname(local_path(path)))
        held.append(sum(os.path.getsize(f) for root in roots for f in files(root)))
        plain.append(lines.agg(F.sum(F.octet_length("value") + 1)).first()[0])

    real = q_quality.write_lines
    monkeypatch.setattr(q_quality, "write_lines", write)
    out = q_quality.qa_row_width(spark, "/root/testdata/sf0.001")
    assert len(plain) == 9 and all(h < p for h, p in zip(held, plain)) and max(held) * 2 < max(plain)
    assert [f for root in roots for f in files(root)] == []
    assert out.count() == 9 and sorted(r.n_lines for r in out.collect())[-3:] == [spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()] * 3
