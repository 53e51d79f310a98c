"""Positional layouts of the nine bulk filing types.

Raw files carry no header: a column is known by its position. Every raw
column is read as a string; the declared type is what staging converts to
(and is kept as column metadata together with the readable alias).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: column order, filing names, readable aliases and declared
# types of each file type, as published for the bulk files. One line per
# column: "<filing name> <alias> <declared type>".
_LAYOUTS = {
    "indiv": """
        cmte_id committee_id string
        amndt_ind amendment_indicator string
        rpt_tp report_type string
        transaction_pgi transaction_primary_general string
        image_num image_number string
        transaction_tp transaction_type string
        entity_tp entity_type string
        name contributor_name string
        city contributor_city string
        state contributor_state string
        zip_code contributor_zip string
        employer contributor_employer string
        occupation contributor_occupation string
        transaction_dt transaction_date string
        transaction_amt transaction_amount float64
        other_id other_id string
        tran_id transaction_id string
        file_num file_number int64
        memo_cd memo_code string
        memo_text memo_text string
        sub_id submission_id int64
    """,
    "cn": """
        cand_id candidate_id string
        cand_name candidate_name string
        cand_pty_affiliation party_affiliation string
        cand_election_yr election_year int16
        cand_office_st office_state string
        cand_office office string
        cand_office_district office_district string
        cand_ici incumbent_challenger_open string
        cand_status candidate_status string
        cand_pcc principal_campaign_cmte string
        cand_st1 mailing_address_1 string
        cand_st2 mailing_address_2 string
        cand_city mailing_city string
        cand_st mailing_state string
        cand_zip mailing_zip string
    """,
    "cm": """
        cmte_id committee_id string
        cmte_nm committee_name string
        tres_nm treasurer_name string
        cmte_st1 street_1 string
        cmte_st2 street_2 string
        cmte_city city string
        cmte_st state string
        cmte_zip zip_code string
        cmte_dsgn designation string
        cmte_tp committee_type string
        cmte_pty_affiliation party_affiliation string
        cmte_filing_freq filing_frequency string
        org_tp interest_group_type string
        connected_org_nm connected_org_name string
        cand_id candidate_id string
    """,
    "ccl": """
        cand_id candidate_id string
        cand_election_yr election_year int16
        fec_election_yr fec_election_yr int16
        cmte_id committee_id string
        cmte_tp committee_type string
        cmte_dsgn designation string
        linkage_id linkage_id int64
    """,
    "oth": """
        cmte_id committee_id string
        amndt_ind amendment_indicator string
        rpt_tp report_type string
        transaction_pgi transaction_primary_general string
        image_num image_number string
        transaction_tp transaction_type string
        entity_tp entity_type string
        name contributor_name string
        city contributor_city string
        state contributor_state string
        zip_code contributor_zip string
        employer contributor_employer string
        occupation contributor_occupation string
        transaction_dt transaction_date string
        transaction_amt transaction_amount float64
        other_id other_id string
        tran_id transaction_id string
        file_num file_number int64
        memo_cd memo_code string
        memo_text memo_text string
        sub_id submission_id int64
    """,
    "pas2": """
        cmte_id committee_id string
        amndt_ind amendment_indicator string
        rpt_tp report_type string
        transaction_pgi transaction_primary_general string
        image_num image_number string
        transaction_tp transaction_type string
        entity_tp entity_type string
        name contributor_name string
        city contributor_city string
        state contributor_state string
        zip_code contributor_zip string
        employer contributor_employer string
        occupation contributor_occupation string
        transaction_dt transaction_date string
        transaction_amt transaction_amount float64
        other_id other_id string
        cand_id candidate_id string
        tran_id transaction_id string
        file_num file_number int64
        memo_cd memo_code string
        memo_text memo_text string
        sub_id submission_id int64
    """,
    "oppexp": """
        cmte_id committee_id string
        amndt_ind amendment_indicator string
        rpt_yr report_year int16
        rpt_tp report_type string
        image_num image_number string
        line_num line_number string
        form_tp_cd form_type string
        sched_tp_cd schedule_type string
        name payee_name string
        city payee_city string
        state payee_state string
        zip_code payee_zip string
        transaction_dt transaction_date string
        transaction_amt transaction_amount float64
        transaction_pgi transaction_primary_general string
        purpose purpose string
        category category_code string
        category_desc category_description string
        memo_cd memo_code string
        memo_text memo_text string
        entity_tp entity_type string
        sub_id submission_id int64
        file_num file_number int64
        tran_id transaction_id string
        back_ref_tran_id back_reference_transaction_id string
    """,
    "weball": """
        cand_id candidate_id string
        cand_name candidate_name string
        cand_ici incumbent_challenger_open string
        pty_cd party_code string
        cand_pty_affiliation party_affiliation string
        ttl_receipts total_receipts float64
        trans_from_auth transfers_from_authorized float64
        ttl_disb total_disbursements float64
        trans_to_auth transfers_to_authorized float64
        coh_bop cash_on_hand_beginning float64
        coh_cop cash_on_hand_close float64
        cand_contrib candidate_contributions float64
        cand_loans candidate_loans float64
        other_loans other_loans float64
        cand_loan_repay candidate_loan_repayments float64
        other_loan_repay other_loan_repayments float64
        debts_owed_by debts_owed_by float64
        ttl_indiv_contrib total_individual_contributions float64
        cand_office_st office_state string
        cand_office_district office_district string
        spec_election special_election string
        prim_election primary_election string
        run_election runoff_election string
        gen_election general_election string
        gen_election_precent general_election_percent float64
        other_pol_cmte_contrib other_committee_contributions float64
        pol_pty_contrib party_contributions float64
        cvg_end_dt coverage_end_date string
        indiv_refunds individual_refunds float64
        cmte_refunds committee_refunds float64
    """,
    "indexp": """
        cmte_id committee_id string
        amndt_ind amendment_indicator string
        rpt_tp report_type string
        transaction_pgi transaction_primary_general string
        image_num image_number string
        line_num line_number string
        form_tp_cd form_type string
        sched_tp_cd schedule_type string
        name payee_name string
        city payee_city string
        state payee_state string
        zip_code payee_zip string
        entity_tp entity_type string
        payee_cmte_id payee_committee_id string
        cand_id candidate_id string
        cand_name candidate_name string
        cand_pty_affiliation party_affiliation string
        cand_office office string
        cand_office_st office_state string
        cand_office_district office_district string
        conduit_cmte_id conduit_committee_id string
        conduit_cmte_nm conduit_committee_name string
        conduit_cmte_st1 conduit_street_1 string
        conduit_cmte_st2 conduit_street_2 string
        conduit_cmte_city conduit_city string
        conduit_cmte_st conduit_state string
        conduit_cmte_zip conduit_zip string
        transaction_dt transaction_date string
        transaction_amt transaction_amount float64
        purpose purpose string
        memo_cd memo_code string
        memo_text memo_text string
        sub_id submission_id int64
        file_num file_number int64
        tran_id transaction_id string
        back_ref_tran_id back_reference_transaction_id string
    """,
}

# Fixed value: inside the indiv ZIP only the root member is read; the
# by-date partials repeat its rows.
INDIV_INNER_FILE = "itcont.txt"

FILE_TYPES = tuple(_LAYOUTS)

_DECLARED = {
    "string": T.StringType(),
    "int16": T.ShortType(),
    "int64": T.LongType(),
    "float64": T.DoubleType(),
}


@dataclass(frozen=True)
class FilingColumn:
    name: str
    alias: str
    declared: str

    @property
    def declared_type(self) -> T.DataType:
        return _DECLARED[self.declared]


def _parse(block: str) -> tuple[FilingColumn, ...]:
    cols = []
    for line in block.strip().splitlines():
        name, alias, declared = line.split()
        cols.append(FilingColumn(name, alias, declared))
    return tuple(cols)


LAYOUTS: dict[str, tuple[FilingColumn, ...]] = {ft: _parse(b) for ft, b in _LAYOUTS.items()}


def columns(file_type: str) -> tuple[FilingColumn, ...]:
    try:
        return LAYOUTS[file_type]
    except KeyError:
        raise ValueError(f"unknown file type {file_type!r}; known: {', '.join(FILE_TYPES)}") from None


def column_names(file_type: str) -> list[str]:
    return [c.name for c in columns(file_type)]


def width(file_type: str) -> int:
    return len(columns(file_type))


def raw_schema(file_type: str) -> T.StructType:
    """All-string read schema; alias and declared type ride along as metadata."""
    return T.StructType([
        T.StructField(c.name, T.StringType(), True,
                      metadata={"alias": c.alias, "declared_type": c.declared})
        for c in columns(file_type)
    ])


def declared_schema(file_type: str) -> T.StructType:
    return T.StructType([
        T.StructField(c.name, c.declared_type, True, metadata={"alias": c.alias})
        for c in columns(file_type)
    ])


def alias_map(file_type: str) -> dict[str, str]:
    return {c.name: c.alias for c in columns(file_type)}
