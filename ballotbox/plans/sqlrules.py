"""DuckDB SQL for the correctness oracle.

Written independently of the Spark code: it has its own list of columns and
rules, and each cleaning rule is DuckDB SQL (``try_strptime``, ``try_cast``),
while the Spark side uses Column functions (``try_to_date``, ``Column.try_cast``).
"""

from __future__ import annotations

from ballotbox.plans import standins

SQL_RULES = {
    "pass": '"{c}"',
    "trim": 'trim("{c}")',
    "zip5": 'left(trim("{c}"), 5)',
    "zip5_null": "nullif(left(trim(\"{c}\"), 5), '')",
    "blank_null": "nullif(trim(\"{c}\"), '')",
    "amount": "try_cast(nullif(trim(\"{c}\"), '') as decimal(14,2))",
    "amount_round": "cast(round(try_cast(nullif(trim(\"{c}\"), '') as decimal(14,2)), 2) as decimal(14,2))",
    "percent": "try_cast(nullif(trim(\"{c}\"), '') as decimal(7,4))",
    "bigint": "try_cast(nullif(trim(\"{c}\"), '') as bigint)",
    "year": "try_cast(case when length(trim(\"{c}\")) = 4 then trim(\"{c}\") end as smallint)",
    "date": "cast(try_strptime(nullif(trim(\"{c}\"), ''), '%m%d%Y') as date)",
    "date2": ("coalesce(cast(try_strptime(nullif(trim(\"{c}\"), ''), '%m/%d/%Y') as date),"
              " cast(try_strptime(nullif(trim(\"{c}\"), ''), '%m%d%Y') as date))"),
}


# The columns of each model in order, with the rule that cleans them (none: as it is).
# Stated here on its own: the checks must not follow the code they check.
MODELS = {
    "indiv": """
        cmte_id amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name:trim city:trim state:trim
        zip_code:zip5 employer:trim occupation:trim transaction_dt:date transaction_amt:amount_round other_id:trim
        tran_id:trim file_num:bigint memo_cd:trim memo_text:trim sub_id:bigint
        """,
    "cn": """
        cand_id cand_name:trim cand_pty_affiliation:trim cand_election_yr:year cand_office_st:trim cand_office:trim
        cand_office_district:trim cand_ici:trim cand_status:trim cand_pcc:trim cand_st1:trim cand_st2:trim
        cand_city:trim cand_st:trim cand_zip:zip5
        """,
    "cm": """
        cmte_id cmte_nm:trim tres_nm:trim cmte_st1:trim cmte_st2:trim cmte_city:trim cmte_st:trim cmte_zip:zip5
        cmte_dsgn:trim cmte_tp:trim cmte_pty_affiliation:trim cmte_filing_freq:trim org_tp:trim connected_org_nm:trim
        cand_id
        """,
    "ccl": """
        cand_id cand_election_yr:year fec_election_yr:year cmte_id cmte_tp cmte_dsgn linkage_id:bigint
        """,
    "oth": """
        cmte_id amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name city state zip_code employer
        occupation transaction_dt:date transaction_amt:amount other_id tran_id file_num:bigint memo_cd memo_text
        sub_id:bigint
        """,
    "pas2": """
        cmte_id amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name city state zip_code employer
        occupation transaction_dt:date transaction_amt:amount other_id cand_id tran_id file_num:bigint memo_cd
        memo_text sub_id:bigint
        """,
    "oppexp": """
        cmte_id amndt_ind rpt_yr rpt_tp image_num line_num form_tp_cd sched_tp_cd name city state zip_code
        transaction_dt:date transaction_amt:amount transaction_pgi purpose category category_desc memo_cd memo_text
        entity_tp sub_id:bigint file_num:bigint tran_id back_ref_tran_id
        """,
    "weball": """
        cand_id cand_name cand_ici pty_cd cand_pty_affiliation ttl_receipts:amount trans_from_auth:amount
        ttl_disb:amount trans_to_auth:amount coh_bop:amount coh_cop:amount cand_contrib:amount cand_loans:amount
        other_loans:amount cand_loan_repay:amount other_loan_repay:amount debts_owed_by:amount
        ttl_indiv_contrib:amount cand_office_st cand_office_district spec_election prim_election run_election
        gen_election gen_election_precent:percent other_pol_cmte_contrib:amount pol_pty_contrib:amount
        cvg_end_dt:date2 indiv_refunds:amount cmte_refunds:amount
        """,
    "indexp": """
        cmte_id amndt_ind rpt_tp transaction_pgi image_num line_num form_tp_cd sched_tp_cd name city state zip_code
        entity_tp payee_cmte_id cand_id cand_name cand_pty_affiliation cand_office cand_office_st cand_office_district
        conduit_cmte_id conduit_cmte_nm conduit_cmte_st1 conduit_cmte_st2 conduit_cmte_city conduit_cmte_st
        conduit_cmte_zip transaction_dt:date transaction_amt:amount purpose memo_cd memo_text sub_id:bigint
        file_num:bigint tran_id back_ref_tran_id
        """,
}


def columns(ft: str) -> list[tuple[str, str]]:
    """(column, rule) of a model."""
    return [(c, rule or "pass") for c, _, rule in (w.partition(":") for w in MODELS[ft].split())]


def rule_sql(rule: str, column: str) -> str:
    return SQL_RULES[rule].format(c=column)


def stg_sql(ft: str, strict: bool = False) -> str:
    strictly = {"pass": "blank_null", "trim": "blank_null", "zip5": "zip5_null"} if strict else {}
    cols = [f'{rule_sql(strictly.get(r, r), c)} as "{c}"' for c, r in columns(ft)]
    return f"select {', '.join(cols)}, cycle from ({standins.raw_sql(ft)}) raw_{ft}"
