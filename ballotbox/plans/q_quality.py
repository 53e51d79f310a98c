"""Queries for the data quality checks (Q1-Q8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.operators import quality as Q
from ballotbox.plans import standins
from ballotbox.plans.q_core import staged
from ballotbox.plans.registry import register
from ballotbox.plans.sqlrules import MODELS, columns, stg_sql
from ballotbox.session import drop_folder, scratch_path
from ballotbox.sources.delimited import read_lines, write_lines


def _model_ft(model: str) -> str:
    return model.removeprefix("stg_")


# The declared checks, stated here on their own for the oracle.
CHECKS_SQL = {
    "stg_indiv": "not_null cmte_id tran_id transaction_dt transaction_amt cycle; unique tran_id; accepted_values cycle; zip zip_code",
    "stg_cm": "not_null cmte_id cmte_nm cycle; unique cmte_id; zip cmte_zip",
    "stg_cn": "not_null cand_id cand_name cycle; unique cand_id; zip cand_zip",
    "stg_ccl": "not_null cand_id cmte_id cycle",
    "stg_oth": "not_null cmte_id tran_id transaction_dt transaction_amt cycle; zip zip_code",
    "stg_pas2": "not_null cmte_id tran_id cand_id transaction_dt transaction_amt cycle; zip zip_code",
    "stg_oppexp": "not_null cmte_id tran_id transaction_dt transaction_amt cycle; zip zip_code",
    "stg_weball": "not_null cand_id cand_name ttl_receipts cycle",
}
UNIQUE_SQL = (("stg_indiv", "tran_id"), ("stg_cm", "cmte_id"), ("stg_cn", "cand_id"))
FAILS_SQL = {
    "not_null": '"{c}" is null',
    "accepted_values": 'not ("{c}" between 2000 and 2024 and "{c}" % 2 = 0)',
    "expression_is_true": 'not (length("{c}") <= 5 or "{c}" is null)',
}


def _check_sql(model: str, kind: str, column: str) -> str:
    src = f"({stg_sql(_model_ft(model))}) s"
    head = f"select '{model}' as model, '{kind}' as check_name, '{column}' as column_name"
    if kind == "unique":
        return (f"{head}, cast(count(*) as bigint) as failures from (select \"{column}\" from {src}"
                f" where \"{column}\" is not null group by 1 having count(*) > 1) d")
    return f"{head}, cast(count(*) filter (where {FAILS_SQL[kind].format(c=column)}) as bigint) as failures from {src}"


def _suite_sql(kinds: tuple[str, ...] | None = None) -> str:
    parts = []
    for model, text in CHECKS_SQL.items():
        for group in text.split(";"):
            kind, *columns = group.split()
            kind = "expression_is_true" if kind == "zip" else kind
            if kinds is None or kind in kinds:
                parts += [_check_sql(model, kind, c) for c in columns]
    return " union all ".join(parts)


def _suite(spark, sf_dir, kinds: tuple[str, ...] | None = None) -> DataFrame:
    reports = []
    for model in Q.MODELS:
        checks = [c for c in Q.declared_checks(model) if kinds is None or c.kind in kinds]
        if checks:
            reports.append(Q.run_checks(staged(spark, sf_dir, _model_ft(model)), model, checks))
    return reduce(DataFrame.unionByName, reports)


@register("qa_not_null", "Q1", lambda: _suite_sql(("not_null",)))
def qa_not_null(spark, sf_dir):
    return _suite(spark, sf_dir, ("not_null",))


@register("qa_unique", "Q2", lambda: " union all ".join(
    f"select '{m}' as model, '{c}' as column_name, \"{c}\" as value, count(*) as n_rows"
    f" from ({stg_sql(_model_ft(m))}) s where \"{c}\" is not null group by \"{c}\" having count(*) > 1"
    for m, c in UNIQUE_SQL))
def qa_unique(spark, sf_dir):
    parts = [Q.duplicate_values(staged(spark, sf_dir, _model_ft(m)), c)
             .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.col(c).alias("value"), "n_rows")
             for m, cols in Q.UNIQUE.items() for c in cols]
    return reduce(DataFrame.unionByName, parts)


@register("qa_unique_by_cycle", "Q2", lambda: " union all ".join(
    f"select '{m}' as model, '{c}' as column_name, cycle, \"{c}\" as value, count(*) as n_rows"
    f" from ({stg_sql(_model_ft(m))}) s where \"{c}\" is not null group by cycle, \"{c}\" having count(*) > 1"
    for m, c in UNIQUE_SQL))
def qa_unique_by_cycle(spark, sf_dir):
    # The other reading of uniqueness: within each cycle instead of across all.
    parts = [Q.duplicate_values(staged(spark, sf_dir, _model_ft(m)), c, by=("cycle",))
             .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"), "cycle", F.col(c).alias("value"),
                     "n_rows")
             for m, cols in Q.UNIQUE.items() for c in cols]
    return reduce(DataFrame.unionByName, parts)


@register("qa_accepted_values", "Q3", lambda: (
    "select 'stg_indiv' as model, 'cycle' as column_name, cast(cycle as varchar) as value, count(*) as n_rows"
    f" from ({stg_sql('indiv')}) s where {FAILS_SQL['accepted_values'].format(c='cycle')} group by cycle"))
def qa_accepted_values(spark, sf_dir):
    parts = [Q.unexpected_values(staged(spark, sf_dir, _model_ft(m)), c, vals)
             .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"), "value", "n_rows")
             for m, spec in Q.ACCEPTED_VALUES.items() for c, vals in spec.items()]
    return reduce(DataFrame.unionByName, parts)


@register("qa_expression", "Q4", lambda: _suite_sql(("expression_is_true",)))
def qa_expression(spark, sf_dir):
    return _suite(spark, sf_dir, ("expression_is_true",))


@register("qa_orphans", "Q5", lambda: (
    f"with l as ({stg_sql('ccl')}) "
    f"select linkage_id, cand_id, cmte_id, cycle, 'cn' as missing_in from l"
    f" where not exists (select 1 from ({stg_sql('cn')}) c where c.cand_id = l.cand_id)"
    f" union all select linkage_id, cand_id, cmte_id, cycle, 'cm' as missing_in from l"
    f" where not exists (select 1 from ({stg_sql('cm')}) m where m.cmte_id = l.cmte_id)"))
def qa_orphans(spark, sf_dir):
    links = staged(spark, sf_dir, "ccl").select("linkage_id", "cand_id", "cmte_id", "cycle")
    no_cand = Q.orphans(links, staged(spark, sf_dir, "cn"), "cand_id").withColumn("missing_in", F.lit("cn"))
    no_cmte = Q.orphans(links, staged(spark, sf_dir, "cm"), "cmte_id").withColumn("missing_in", F.lit("cm"))
    return no_cand.unionByName(no_cmte)


@register("qa_amendment_dups", "Q6", lambda: (
    f"select tran_id, count(*) as n_rows,"
    f" array_to_string(list_sort(list(distinct amndt_ind)), ',') as amendment_codes"
    f" from ({stg_sql('indiv')}) s where tran_id is not null group by tran_id having count(*) > 1"))
def qa_amendment_dups(spark, sf_dir):
    return Q.amendment_duplicates(staged(spark, sf_dir, "indiv"))


def _lines_sql(ft: str) -> str:
    cols = ", ".join(f'"{c}"' for c, _ in columns(ft))
    return f"select concat_ws('|', {cols}) as value from ({standins.raw_sql(ft)}) r"


@register("qa_row_width", "Q7", lambda: " union all ".join(
    f"select '{ft}' as file_type, {len(columns(ft))} as expected_width, count(*) as n_lines,"
    f" count(*) filter (where len(string_split(value, '|')) <> {len(columns(ft))}) as n_bad_width,"
    f" cast(min(len(string_split(value, '|'))) as int) as min_width,"
    f" cast(max(len(string_split(value, '|'))) as int) as max_width from ({_lines_sql(ft)}) x"
    for ft in MODELS))
def qa_row_width(spark, sf_dir):
    # Files as written by an exporter that drops NULL fields (concat_ws skips
    # them): rows with a NULL come out short. The lines are checked as read. All
    # of them are some thirty times the tables, so they are written compressed and
    # those of one file type are taken away before the next are written. File types
    # whose rows come out of a shuffle are last: its files stay for some time.
    base = scratch_path(spark, "row-width")
    for ft in sorted(schemas.FILE_TYPES, key=lambda ft: ft in standins.SHUFFLED):
        path = f"{base}/lines/{ft}"
        lines = standins.raw(spark, sf_dir, ft).select(F.concat_ws("|", *schemas.column_names(ft)).alias("value"))
        write_lines(lines, path, partition_by=None, compressed=True)
        found = Q.row_widths(read_lines(spark, path).withColumn("file_type", F.lit(ft)), {ft: schemas.width(ft)})
        found.write.mode("append").parquet(f"{base}/widths")
        drop_folder(spark, path)
    return spark.read.schema(found.schema).parquet(f"{base}/widths")


@register("qa_suite", "Q8", lambda: _suite_sql())
def qa_suite(spark, sf_dir):
    return _suite(spark, sf_dir)
