"""Queries for cleaning rules (P1-P15), staging models (T1-T10) and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.functions import normalize as N
from ballotbox.operators import marts, staging
from ballotbox.plans import standins
from ballotbox.plans.registry import register
from ballotbox.plans.sqlrules import rule_sql, stg_sql


def staged(spark: SparkSession, sf_dir: str, ft: str, strict: bool = False) -> DataFrame:
    return staging.stage(standins.raw(spark, sf_dir, ft), ft, strict=strict)


def _raw(ft: str) -> str:
    return f"({standins.raw_sql(ft)}) r"


# ------------------------------------------------------------ P1 - P15

@register("norm_trim", "P1", lambda: (
    f"select cmte_id, trim(cmte_nm) as cmte_nm, trim(tres_nm) as tres_nm, trim(cmte_city) as cmte_city,"
    f" cycle from {_raw('cm')}"))
def norm_trim(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "cm")
    return r.select("cmte_id", *[N.trim_spaces(c).alias(c) for c in ("cmte_nm", "tres_nm", "cmte_city")], "cycle")


@register("norm_zip5", "P2", lambda: (
    f"select sub_id, zip_code as zip_raw, left(trim(zip_code), 5) as zip5 from {_raw('indiv')}"))
def norm_zip5(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "indiv")
    return r.select("sub_id", F.col("zip_code").alias("zip_raw"), N.zip5("zip_code").alias("zip5"))


@register("norm_blank_to_null", "P3", lambda: (
    f"select sub_id, nullif(trim(occupation), '') as occupation, nullif(trim(city), '') as city,"
    f" nullif(trim(memo_cd), '') as memo_cd, nullif(trim(transaction_amt), '') as transaction_amt"
    f" from {_raw('indiv')}"))
def norm_blank_to_null(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "indiv")
    return r.select("sub_id", *[N.blank_to_null(c).alias(c)
                                for c in ("occupation", "city", "memo_cd", "transaction_amt")])


@register("norm_amount", "P4", lambda: (
    f"select sub_id, transaction_amt as amt_raw, {rule_sql('amount', 'transaction_amt')} as amount,"
    f" {rule_sql('amount_round', 'transaction_amt')} as amount_rounded from {_raw('indiv')}"))
def norm_amount(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "indiv")
    return r.select("sub_id", F.col("transaction_amt").alias("amt_raw"),
                    N.amount("transaction_amt").alias("amount"),
                    N.amount("transaction_amt", rounded=True).alias("amount_rounded"))


_DISCOUNT_TEXT = ("case when (l_orderkey * 8 + l_linenumber) % 13 = 0"
                  " then cast(cast(l_discount as decimal(7,4)) as string) || '5'"
                  " when (l_orderkey * 8 + l_linenumber) % 17 = 0 then ' '"
                  " when (l_orderkey * 8 + l_linenumber) % 19 = 0 then '12345.1'"
                  " else ' ' || cast(cast(l_discount as decimal(7,4)) as string) end")


@register("norm_percent", "P5", lambda: (
    f"select l_orderkey, l_linenumber, try_cast(nullif(trim(d), '') as decimal(7,4)) as discount_pct"
    f" from (select l_orderkey, l_linenumber, {_DISCOUNT_TEXT} as d from lineitem) t"))
def norm_percent(spark, sf_dir):
    li = standins.table(spark, sf_dir, "lineitem")
    return (li.select("l_orderkey", "l_linenumber", F.expr(_DISCOUNT_TEXT).alias("d"))
            .select("l_orderkey", "l_linenumber", N.percent("d").alias("discount_pct")))


@register("norm_bigint", "P6", lambda: (
    f"select sub_id, {rule_sql('bigint', 'file_num')} as file_num, {rule_sql('bigint', 'sub_id')} as sub_id_num"
    f" from {_raw('indiv')}"))
def norm_bigint(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "indiv")
    return r.select("sub_id", N.to_bigint("file_num").alias("file_num"), N.to_bigint("sub_id").alias("sub_id_num"))


@register("norm_year", "P7", lambda: (
    f"select cand_id, cand_election_yr as yr_raw, {rule_sql('year', 'cand_election_yr')} as election_yr"
    f" from {_raw('cn')}"))
def norm_year(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "cn")
    return r.select("cand_id", F.col("cand_election_yr").alias("yr_raw"),
                    N.year4("cand_election_yr").alias("election_yr"))


@register("norm_date", "P8", lambda: (
    f"select sub_id, transaction_dt as dt_raw, {rule_sql('date', 'transaction_dt')} as transaction_dt"
    f" from {_raw('indiv')}"))
def norm_date(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "indiv")
    return r.select("sub_id", F.col("transaction_dt").alias("dt_raw"),
                    N.date_mmddyyyy("transaction_dt").alias("transaction_dt"))


@register("norm_date_two_formats", "P9", lambda: (
    f"select cand_id, cycle, cvg_end_dt as dt_raw, {rule_sql('date2', 'cvg_end_dt')} as cvg_end_dt"
    f" from {_raw('weball')}"))
def norm_date_two_formats(spark, sf_dir):
    r = standins.raw(spark, sf_dir, "weball")
    return r.select("cand_id", "cycle", F.col("cvg_end_dt").alias("dt_raw"),
                    N.date_two_formats("cvg_end_dt").alias("cvg_end_dt"))


@register("text_length", "P10", lambda: (
    "select doc_id, cast(length(text) as bigint) as text_chars from documents"))
def text_length(spark, sf_dir):
    d = standins.table(spark, sf_dir, "documents")
    return d.select("doc_id", N.text_length("text").alias("text_chars"))


@register("rename_aliases", "P12", lambda: (
    "select " + ", ".join(f'"{c.name}" as "{c.alias}"' for c in schemas.columns("indiv"))
    + f", cycle from ({stg_sql('indiv')}) s"))
def rename_aliases(spark, sf_dir):
    return staging.rename_to_aliases(staged(spark, sf_dir, "indiv"), "indiv")


@register("text_preview", "P13", lambda: (
    "select page_id, substring(html, 1, 5000) as preview, cast(length(html) as bigint) as html_chars from pages"))
def text_preview(spark, sf_dir):
    p = standins.table(spark, sf_dir, "pages")
    return p.select("page_id", N.preview("html").alias("preview"), N.text_length("html").alias("html_chars"))


@register("source_url", "P14", lambda: (
    "select file_type, cycle, '" + N.BULK_BASE_URL + "/' || cast(cycle as varchar) || '/' || file_type"
    " || right(cast(cycle as varchar), 2) || '.zip' as url"
    f" from (select distinct file_type, cycle from ({standins.probe_log_sql()}) l) k"))
def source_url(spark, sf_dir):
    keys = standins.probe_log(spark, sf_dir).select("file_type", "cycle").distinct()
    return keys.select("file_type", "cycle", N.source_url("file_type", "cycle").alias("url"))


@register("local_date", "P15", lambda: (
    "select event_id, ts, cast(timezone('America/Los_Angeles', timezone('UTC', ts)) as date) as local_date"
    " from events"))
def local_date(spark, sf_dir):
    e = standins.table(spark, sf_dir, "events")
    return e.select("event_id", "ts", N.local_date("ts").alias("local_date"))


# ------------------------------------------------------------ T1 - T10

def _stg_query(ft: str, name: str, op: str):
    @register(name, op, lambda: stg_sql(ft))
    def q(spark, sf_dir):
        return staged(spark, sf_dir, ft)
    return q


for _op, _ft in (("T1", "indiv"), ("T2", "cm"), ("T3", "cn"), ("T4", "ccl"), ("T5", "oth"),
                 ("T6", "pas2"), ("T7", "oppexp"), ("T8", "weball"), ("T10", "indexp")):
    _stg_query(_ft, f"stg_{_ft}", _op)


@register("stg_indiv_strict", "T1", lambda: stg_sql("indiv", strict=True))
def stg_indiv_strict(spark, sf_dir):
    return staged(spark, sf_dir, "indiv", strict=True)


@register("stg_indiv_typed", "T1", lambda: stg_sql("indiv"))
def stg_indiv_typed(spark, sf_dir):
    # The staged model written once as typed, cycle-partitioned parquet and
    # read back: later filters on dates and amounts push into the scan.
    from ballotbox.session import scratch_path

    path = scratch_path(spark, "staged-indiv")
    staging.materialize(standins.raw(spark, sf_dir, "indiv"), "indiv", path)
    cols = schemas.column_names("indiv") + ["cycle"]
    return spark.read.parquet(path).select(*cols)


@register("stg_http_source", "T9", lambda: (
    "select fetched_at, url, status_code, cast(length(substring(content, 1, 5000)) as bigint) as preview_length"
    f" from ({standins.http_records_sql()}) h"))
def stg_http_source(spark, sf_dir):
    return staging.stage_http_source(standins.http_records(spark, sf_dir))


# ------------------------------------------------------------ U1 - U3

def _cycles_sql() -> str:
    return "select distinct cast(year(o_orderdate) + year(o_orderdate) % 2 as int) as cycle from orders"


@register("union_cycles", "U1", lambda: stg_sql("indiv"))
def union_cycles(spark, sf_dir):
    # Raw filings stored per cycle (cycle=YYYY folders); one staged branch per
    # cycle, each a pruned scan of its own folder, as the per-cycle models
    # union them. The cycle list comes from the folder listing, not a scan.
    from ballotbox.session import scratch_path
    from ballotbox.sources import parquet

    root = scratch_path(spark, "raw")
    parquet.write_raw(standins.raw(spark, sf_dir, "indiv"), root, "indiv")
    cols = schemas.column_names("indiv") + ["cycle"]
    frames = [staging.stage(parquet.read_raw(spark, root, "indiv", [c]).select(*cols), "indiv")
              for c in parquet.list_cycles(spark, root, "indiv")]
    return marts.union_cycles(frames)


def _all_query(ft: str):
    @register(f"marts_{ft}_all", "U2", lambda: f"select * from ({stg_sql(ft)}) s")
    def q(spark, sf_dir):
        # The raw table is written in two loads; the view is over what is there.
        from ballotbox.session import scratch_path
        from ballotbox.sources import parquet

        root, raw = scratch_path(spark, "raw"), standins.raw(spark, sf_dir, ft, by_cycle=True)
        parquet.write_raw(raw.where("cycle <= 1996"), root, ft)
        parquet.write_raw(raw.where("NOT coalesce(cycle <= 1996, false)"), root, ft)
        return marts.all_cycles(spark, root, ft)
    return q


for _ft in schemas.FILE_TYPES:
    _all_query(_ft)


@register("marts_committee_totals", "U3", lambda: (
    "select cmte_id, cycle, count(*) as n_contributions, count(transaction_amt) as n_amounts,"
    " cast(sum(transaction_amt) as decimal(38,2)) as total_amt, min(transaction_dt) as first_dt,"
    f" max(transaction_dt) as last_dt from ({stg_sql('indiv')}) s group by cmte_id, cycle"))
def marts_committee_totals(spark, sf_dir):
    return marts.committee_totals(staged(spark, sf_dir, "indiv"))


@register("marts_candidate_receipts", "U3", lambda: (
    f"with totals as (select cmte_id, cycle, sum(transaction_amt) as total_amt from ({stg_sql('indiv')}) s"
    f" group by cmte_id, cycle),"
    f" per_cand as (select l.cand_id, l.cycle, count(*) as n_committees,"
    f" cast(sum(t.total_amt) as decimal(38,2)) as total_receipts"
    f" from (select distinct cand_id, cmte_id, cycle from ({stg_sql('ccl')}) x) l join totals t on l.cmte_id = t.cmte_id and l.cycle = t.cycle"
    f" group by l.cand_id, l.cycle),"
    f" names as (select cand_id, max(cand_name) as cand_name from ({stg_sql('cn')}) c group by cand_id)"
    f" select p.cand_id, p.cycle, p.n_committees, p.total_receipts, n.cand_name"
    f" from per_cand p left join names n on p.cand_id = n.cand_id"))
def marts_candidate_receipts(spark, sf_dir):
    return marts.candidate_receipts(staged(spark, sf_dir, "indiv"), staged(spark, sf_dir, "ccl"),
                                    staged(spark, sf_dir, "cn"))


@register("marts_committee_profile", "U3", lambda: (
    f"with m as (select cmte_id, cmte_nm, cmte_tp, cmte_pty_affiliation from ({stg_sql('cm')}) c"
    f" qualify row_number() over (partition by cmte_id order by cycle desc, cmte_nm desc, cmte_tp desc,"
    f" cmte_pty_affiliation desc) = 1),"
    f" t as (select cmte_id, cycle, count(*) as n_contributions,"
    f" cast(sum(transaction_amt) as decimal(38,2)) as total_amt from ({stg_sql('indiv')}) s group by 1, 2)"
    f" select t.cmte_id, t.cycle, t.n_contributions, t.total_amt, m.cmte_nm, m.cmte_tp, m.cmte_pty_affiliation"
    f" from t left join m on t.cmte_id = m.cmte_id"))
def marts_committee_profile(spark, sf_dir):
    return marts.committee_profile(staged(spark, sf_dir, "indiv"), staged(spark, sf_dir, "cm"))


STAR_BUCKETS = 8


@register("marts_candidate_star", "U3", lambda: (
    f"with t as (select cmte_id, cycle, count(*) as n_contributions, cast(sum(transaction_amt) as decimal(38,2)) as total_amt,"
    f" min(transaction_dt) as first_dt, max(transaction_dt) as last_dt from ({stg_sql('indiv')}) s group by cmte_id, cycle),"
    f" m as (select cmte_id, cycle, cmte_nm, cmte_tp from ({stg_sql('cm')}) c qualify row_number() over"
    f" (partition by cmte_id, cycle order by cmte_nm desc, cmte_tp desc) = 1),"
    f" n as (select cand_id, max(cand_name) as cand_name from ({stg_sql('cn')}) k group by cand_id)"
    f" select l.cand_id, l.cmte_id, l.cycle, t.n_contributions, t.total_amt, t.first_dt, t.last_dt, m.cmte_nm, m.cmte_tp, n.cand_name"
    f" from (select distinct cand_id, cmte_id, cycle from ({stg_sql('ccl')}) x) l join t using (cmte_id, cycle)"
    f" left join m using (cmte_id, cycle) left join n on n.cand_id = l.cand_id"))
def marts_candidate_star(spark, sf_dir):
    # Facts, committees and links stored by committee; joined where they lie.
    stored = marts.store_star(staged(spark, sf_dir, "indiv"), staged(spark, sf_dir, "cm"), staged(spark, sf_dir, "ccl"), STAR_BUCKETS)
    return marts.candidate_star(*stored, staged(spark, sf_dir, "cn")).withColumn("n_contributions", F.col("n_contributions").cast("bigint"))


def _rollup_sql() -> str:
    from ballotbox.plans.registry import QUERIES

    sets = ", ".join("(" + ", ".join(s) + ")" for s in marts.ROLLUP_SETS)
    return (f"with w as (select cand_id, cand_pty_affiliation as party, cand_office as office from ({stg_sql('cn')}) c qualify"
            f" row_number() over (partition by cand_id order by cycle desc, cand_pty_affiliation desc, cand_office desc) = 1)"
            f" select party, office, cycle, cast(grouping(party) as int) as all_party, cast(grouping(office) as int) as all_office,"
            f" cast(grouping(cycle) as int) as all_cycle, count(*) as n_candidates,"
            f" cast(sum(total_receipts) as decimal(38,2)) as total_receipts"
            f" from ({QUERIES['marts_candidate_receipts'].oracle()}) r left join w using (cand_id) group by grouping sets ({sets})")


@register("marts_receipts_rollup", "U3", _rollup_sql)
def marts_receipts_rollup(spark, sf_dir):
    # Subtotals by party, office and cycle in one pass over the receipts.
    return marts.receipts_rollup(marts_candidate_receipts(spark, sf_dir), staged(spark, sf_dir, "cn"))
