"""Staging models T1-T10: one ``select`` per model, driven by a rule map.

Each map names the rule applied to a column; columns not named pass through
untouched, and ``cycle`` (the partition column of the raw data) is kept as an
integer. Default mode follows the cleaning the models actually do column by
column; ``strict=True`` applies the documented rules to every text column
(trim, cut ZIP codes, blanks to NULL).

The result is a narrow projection: no shuffle, one codegen stage, and filters
on ``cycle`` prune raw partitions before anything is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.functions import normalize as N

_TEXT_TRIM_INDIV = ("name", "city", "state", "employer", "occupation", "other_id", "tran_id",
                    "memo_cd", "memo_text")

# Rule per column; anything absent passes through.
RULE_MAPS: dict[str, dict[str, str]] = {
    "indiv": {
        **{c: "trim" for c in _TEXT_TRIM_INDIV},
        "zip_code": "zip5",
        "transaction_dt": "date",
        "transaction_amt": "amount_round",
        "file_num": "bigint",
        "sub_id": "bigint",
    },
    "cm": {
        **{c: "trim" for c in ("cmte_nm", "tres_nm", "cmte_st1", "cmte_st2", "cmte_city", "cmte_st",
                               "cmte_dsgn", "cmte_tp", "cmte_pty_affiliation", "cmte_filing_freq",
                               "org_tp", "connected_org_nm")},
        "cmte_zip": "zip5",
    },
    "cn": {
        **{c: "trim" for c in ("cand_name", "cand_pty_affiliation", "cand_office_st", "cand_office",
                               "cand_office_district", "cand_ici", "cand_status", "cand_pcc",
                               "cand_st1", "cand_st2", "cand_city", "cand_st")},
        "cand_election_yr": "year",
        "cand_zip": "zip5",
    },
    "ccl": {"cand_election_yr": "year", "fec_election_yr": "year", "linkage_id": "bigint"},
    "oth": {"transaction_dt": "date", "transaction_amt": "amount", "file_num": "bigint", "sub_id": "bigint"},
    "pas2": {"transaction_dt": "date", "transaction_amt": "amount", "file_num": "bigint", "sub_id": "bigint"},
    "oppexp": {"transaction_dt": "date", "transaction_amt": "amount", "sub_id": "bigint", "file_num": "bigint"},
    "indexp": {"transaction_dt": "date", "transaction_amt": "amount", "sub_id": "bigint", "file_num": "bigint"},
    "weball": {
        **{c: "amount" for c in ("ttl_receipts", "trans_from_auth", "ttl_disb", "trans_to_auth", "coh_bop",
                                 "coh_cop", "cand_contrib", "cand_loans", "other_loans", "cand_loan_repay",
                                 "other_loan_repay", "debts_owed_by", "ttl_indiv_contrib",
                                 "other_pol_cmte_contrib", "pol_pty_contrib", "indiv_refunds",
                                 "cmte_refunds")},
        "gen_election_precent": "percent",
        "cvg_end_dt": "date2",
    },
}

STAGED_TYPES = tuple(RULE_MAPS)


def rule_for(file_type: str, column: str, strict: bool = False) -> str:
    rule = RULE_MAPS[file_type].get(column, "pass")
    if strict:
        if rule in ("pass", "trim"):
            return "blank_null"
        if rule == "zip5":
            return "zip5_null"
    return rule


def _clean(rule: str, name: str) -> Column:
    if rule == "zip5_null":
        return F.nullif(N.zip5(name), F.lit(""))
    return N.apply_rule(rule, name)


def stage(raw: DataFrame, file_type: str, strict: bool = False) -> DataFrame:
    """Clean one raw file type; keeps filing names and the ``cycle`` column."""
    if file_type not in RULE_MAPS:
        raise ValueError(f"no staging model for {file_type!r}")
    cols = [_clean(rule_for(file_type, c, strict), c).alias(c) for c in schemas.column_names(file_type)]
    if "cycle" in raw.columns:
        cols.append(F.col("cycle").cast("int").alias("cycle"))
    return raw.select(*cols)


def materialize(raw: DataFrame, file_type: str, path: str, strict: bool = False) -> str:
    """Write a staged model as typed parquet partitioned by ``cycle``.

    Filters on cleaned columns (dates, amounts, ids) cannot reach a raw
    all-string scan: they sit above ``try_to_date`` / ``try_cast``. Reading
    this typed copy instead, Spark pushes them into the parquet reader (row
    group statistics) and prunes cycles by folder. Only the cycles present
    in ``raw`` are replaced.
    """
    staged = stage(raw, file_type, strict)
    (staged.sortWithinPartitions("cycle")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("cycle").parquet(path))
    return path


def stage_http_source(records: DataFrame) -> DataFrame:
    """Fetched records without their text, keeping only its length."""
    return records.select("fetched_at", "url", "status_code",
                          N.text_length(N.preview("content")).alias("preview_length"))


def rename_to_aliases(df: DataFrame, file_type: str) -> DataFrame:
    """Filing names to readable aliases (columns not in the layout stay)."""
    mapping = {k: v for k, v in schemas.alias_map(file_type).items() if k in df.columns}
    return df.withColumnsRenamed(mapping)
