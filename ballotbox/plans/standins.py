"""Stand-in raw filings derived from the driver tables.

No bulk filing data ships with the repository, so every raw table is derived
from the driver's parquet tables (orders, lineitem, customer, supplier, events,
documents, pages). Each raw column is one SQL expression written in the subset
that Spark SQL and DuckDB read the same way, so both sides of the correctness
check start from byte-identical all-string rows; the cleaning rules are then
implemented separately on each side.

Bad and blank values are placed by ``key % n`` rules so that every cleaning
rule meets the inputs it must reject. No row is ever dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.functions.normalize import cycle_of
from ballotbox.functions.text import let

FILE_TYPES = schemas.FILE_TYPES

# Fixed value: the file types in the order of the probe keys.
PROBE_FILE_TYPES = ("indiv", "cn", "cm", "oth", "oppexp", "ccl", "weball", "pas2", "indexp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- snippets

def _id8(prefix: str, n: str) -> str:
    return f"'{prefix}' || lpad(cast({n} as string), 8, '0')"


def _mmddyyyy(d: str) -> str:
    return (f"lpad(cast(month({d}) as string), 2, '0') || lpad(cast(day({d}) as string), 2, '0')"
            f" || cast(year({d}) as string)")


def _slash(d: str) -> str:
    return f"cast(month({d}) as string) || '/' || cast(day({d}) as string) || '/' || cast(year({d}) as string)"


def _money(x: str) -> str:
    return f"cast(cast({x} as decimal(14,2)) as string)"


def _cycle(d: str) -> str:
    return f"cast(year({d}) + year({d}) % 2 as int)"


def _pad(k: str, text: str) -> str:
    return f"case when {k} % 29 = 0 then chr(9) || ' ' || {text} else '  ' || {text} || ' ' end"


def _date_text(k: str, d: str) -> str:
    return (f"case when {k} % 23 = 0 then '13152024' when {k} % 41 = 0 then ''"
            f" when {k} % 43 = 0 then 'N/A' when {k} % 47 = 0 then '0230' || cast(year({d}) as string)"
            f" when {k} % 5 = 0 then ' ' || {_mmddyyyy(d)} || ' ' else {_mmddyyyy(d)} end")


def _amount_text(k: str, x: str) -> str:
    m = _money(x)
    return (f"case when {k} % 13 = 0 then {m} || '5' when {k} % 17 = 0 then ''"
            f" when {k} % 19 = 0 then 'n/a' when {k} % 53 = 0 then '1,000.00'"
            f" when {k} % 59 = 0 then '999999999999999' when {k} % 71 = 0 then '1e3'"
            f" when {k} % 11 = 0 then '-' || {m} when {k} % 3 = 0 then '  ' || {m} || ' ' else {m} end")


def _bigint_text(k: str, n: str) -> str:
    return (f"case when {k} % 61 = 0 then '12abc' when {k} % 67 = 0 then ''"
            f" when {k} % 4 = 0 then ' ' || cast({n} as string) || ' ' else cast({n} as string) end")


def _sub_id(k: str) -> str:
    n = f"cast({k} + 4000000000000 as string)"
    return f"case when {k} % 8 = 0 then ' ' || {n} || ' ' else {n} end"


def _zip_text(k: str, a: str, b: str) -> str:
    z5 = f"lpad(cast(({a}) % 100000 as string), 5, '0')"
    z4 = f"lpad(cast(({b}) % 10000 as string), 4, '0')"
    return (f"case when {k} % 31 = 0 then NULL when {k} % 37 = 0 then '  '"
            f" when {k} % 2 = 0 then '  ' || {z5} || '-' || {z4} else {z5} || ' ' end")


def _choose(k: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {k} % {len(values)} {arms} else '{values[-1]}' end"


def _tran_id(k: str) -> str:
    base = f"'SA11AI.' || cast(case when {k} % 20 = 1 then {k} - 1 else {k} end as string)"
    return f"case when {k} % 27 = 0 then ' ' || {base} || ' ' else {base} end"


# Transaction-shaped files (indiv, oth, pas2, oppexp, indexp) share one base.
_ORDERS = dict(k="o_orderkey", d="o_orderdate", x="o_totalprice", p="o_custkey",
               flag="o_orderstatus", tag="o_orderpriority")
_LINES = dict(k="(l_orderkey * 8 + l_linenumber)", d="l_shipdate", x="l_extendedprice", p="l_partkey",
              flag="l_returnflag", tag="l_linestatus")


def _txn(b: dict, who: str) -> dict[str, str]:
    k, d, x, p, flag, tag = b["k"], b["d"], b["x"], b["p"], b["flag"], b["tag"]
    return {
        "cmte_id": _id8("C", p),
        "amndt_ind": f"case when {k} % 20 = 1 then 'A' when {k} % 7 = 0 then 'T' else 'N' end",
        "rpt_tp": _choose(k, ("Q1", "Q2", "Q3", "YE")),
        "transaction_pgi": f"(case when {k} % 2 = 0 then 'P' else 'G' end) || cast(year({d}) as string)",
        "image_num": f"cast({k} * 3 + 201900000000 as string)",
        "transaction_tp": f"case {flag} when 'F' then '15' when 'O' then '15E' else '22Y' end",
        "entity_tp": f"case when {k} % 5 = 0 then 'ORG' else 'IND' end",
        "name": _pad(k, f"upper({tag}) || ' {who} ' || cast({p} as string)"),
        "city": f"case when {k} % 37 = 0 then '   ' else ' CITY ' || cast({p} % 50 as string) end",
        "state": _choose(k, ("CA", "NY", "TX ")),
        "zip_code": _zip_text(k, f"{p} * 7", k),
        "employer": f"' EMPLOYER ' || {flag} || ' '",
        "occupation": f"case when {k} % 11 = 0 then '' else 'OCC ' || cast({k} % 13 as string) end",
        "transaction_dt": _date_text(k, d),
        "transaction_amt": _amount_text(k, x),
        "other_id": f"case when {k} % 9 = 0 then {_id8('C', p + ' + 1')} else '' end",
        "tran_id": _tran_id(k),
        "file_num": _bigint_text(k, f"{k} % 100000 + 1000000"),
        "memo_cd": f"case when {k} % 5 = 0 then 'X' else '' end",
        "memo_text": f"case when {k} % 5 = 0 then ' MEMO ' || cast({k} as string) else '' end",
        "sub_id": _sub_id(k),
        "cycle": _cycle(d),
    }


def _indiv() -> dict[str, str]:
    return _txn(_ORDERS, "DONOR")


def _oth() -> dict[str, str]:
    cols = _txn(_ORDERS, "PAC")
    k, p = _ORDERS["k"], _ORDERS["p"]
    cols["other_id"] = _id8("C", f"{p} + 3")
    cols["transaction_tp"] = _choose(k, ("18K", "18G", "24G"))
    cols["entity_tp"] = "'PAC'"
    return cols


def _pas2() -> dict[str, str]:
    cols = _txn(_LINES, "CMTE")
    cols["cand_id"] = _id8("H", "l_suppkey")
    cols["transaction_tp"] = _choose(_LINES["k"], ("24K", "24E", "24Z"))
    return cols


def _oppexp() -> dict[str, str]:
    cols = _txn(_LINES, "PAYEE")
    k, d = _LINES["k"], _LINES["d"]
    cols.update({
        "rpt_yr": f"case when {k} % 41 = 0 then '' else cast(year({d}) as string) end",
        "line_num": _choose(k, ("17", "21B", "29")),
        "form_tp_cd": "'F3X'",
        "sched_tp_cd": "'SB'",
        "purpose": f"case l_returnflag when 'R' then ' REFUND ' when 'A' then 'TRAVEL' else 'PAYROLL  ' end",
        "category": f"lpad(cast({k} % 12 as string), 3, '0')",
        "category_desc": f"'CATEGORY ' || cast({k} % 12 as string)",
        "back_ref_tran_id": f"case when {k} % 6 = 0 then 'SA11AI.' || cast({k} - 8 as string) else '' end",
    })
    return cols


def _indexp() -> dict[str, str]:
    cols = _oppexp()
    k = _LINES["k"]
    cols.update({
        "payee_cmte_id": f"case when {k} % 4 = 0 then {_id8('C', 'l_partkey + 5')} else '' end",
        "cand_id": _id8("H", "l_suppkey"),
        "cand_name": "' CANDIDATE ' || cast(l_suppkey as string)",
        "cand_pty_affiliation": _choose("l_suppkey", ("DEM", "REP", "LIB")),
        "cand_office": _choose("l_suppkey", ("H", "S", "P")),
        "cand_office_st": _choose("l_suppkey", ("CA", "NY", "TX", "FL")),
        "cand_office_district": "lpad(cast(l_suppkey % 53 as string), 2, '0')",
        "conduit_cmte_id": f"case when {k} % 10 = 0 then {_id8('C', 'l_partkey + 9')} else '' end",
        "conduit_cmte_nm": f"case when {k} % 10 = 0 then ' CONDUIT ' || cast(l_partkey as string) else '' end",
        "conduit_cmte_st1": f"case when {k} % 10 = 0 then cast(l_partkey % 900 + 100 as string) || ' OAK AVE' else '' end",
        "conduit_cmte_st2": "''",
        "conduit_cmte_city": f"case when {k} % 10 = 0 then 'CITY ' || cast(l_partkey % 50 as string) else '' end",
        "conduit_cmte_st": f"case when {k} % 10 = 0 then 'VA' else '' end",
        "conduit_cmte_zip": f"case when {k} % 10 = 0 then {_zip_text(k, 'l_partkey * 3', 'l_partkey')} else '' end",
        "sched_tp_cd": "'SE'",
        "form_tp_cd": "'F24'",
    })
    return cols


def _cm() -> dict[str, str]:
    k = "c_custkey"
    return {
        "cmte_id": _id8("C", k),
        "cmte_nm": f"case when {k} % 43 = 0 then NULL else {_pad(k, 'c_name')} end",
        "tres_nm": f"'  TREASURER ' || cast({k} % 97 as string)",
        "cmte_st1": f"cast({k} % 900 + 100 as string) || ' MAIN ST '",
        "cmte_st2": f"case when {k} % 3 = 0 then 'SUITE ' || cast({k} % 40 as string) else '' end",
        "cmte_city": "' ' || c_mktsegment || ' CITY'",
        "cmte_st": _choose("c_nationkey", ("CA", "NY", "TX", "FL", "OH")),
        "cmte_zip": _zip_text(k, f"{k} * 11", f"{k} * 3"),
        "cmte_dsgn": _choose(k, ("P", "A", "U", "B")),
        "cmte_tp": _choose(k, ("H", "S", "P", "Q", "N")),
        "cmte_pty_affiliation": _choose(k, ("DEM", "REP", "IND")),
        "cmte_filing_freq": _choose(k, ("Q", "M")),
        "org_tp": f"case when {k} % 6 = 0 then 'C' else '' end",
        "connected_org_nm": f"case when {k} % 6 = 0 then ' ORG ' || c_mktsegment else '' end",
        "cand_id": f"case when {k} % 4 = 0 then {_id8('H', f'{k} % 100')} else '' end",
        "cycle": f"cast(1996 + 2 * ({k} % 4) as int)",
    }


def _cn() -> dict[str, str]:
    k = "s_suppkey"
    return {
        "cand_id": _id8("H", k),
        "cand_name": _pad(k, "s_name"),
        "cand_pty_affiliation": _choose(k, ("DEM", "REP", "LIB")),
        "cand_election_yr": (f"case {k} % 6 when 0 then '2024' when 1 then ' 2022 ' when 2 then '24'"
                             f" when 3 then '99999' when 4 then '' else '2020' end"),
        "cand_office_st": _choose("s_nationkey", ("CA", "NY", "TX", "FL")),
        "cand_office": _choose(k, ("H", "S", "P")),
        "cand_office_district": f"lpad(cast({k} % 53 as string), 2, '0')",
        "cand_ici": _choose(k, ("I", "C", "O")),
        "cand_status": _choose(k, ("C", "N", "P")),
        "cand_pcc": _id8("C", f"{k} * 3"),
        "cand_st1": f"cast({k} % 700 + 10 as string) || ' ELM ST'",
        "cand_st2": "''",
        "cand_city": f"' TOWN ' || cast(s_nationkey as string)",
        "cand_st": _choose("s_nationkey", ("CA", "NY", "TX", "FL")),
        "cand_zip": _zip_text(k, f"{k} * 17", f"{k} * 5"),
        "cycle": f"cast(1996 + 2 * ({k} % 4) as int)",
    }


def _ccl() -> dict[str, str]:
    sc = "(s + c)"
    link = "cast(s * 100000 + c as string)"
    return {
        "cand_id": f"case when {sc} % 97 = 0 then 'H9' || lpad(cast(s as string), 7, '0') else {_id8('H', 's')} end",
        "cand_election_yr": (f"case {sc} % 5 when 0 then ' ' || cast(y as string)"
                             f" when 1 then cast(y % 100 as string) else cast(y as string) end"),
        "fec_election_yr": "cast(y as string)",
        "cmte_id": _id8("C", "c"),
        "cmte_tp": _choose("s", ("H", "S", "P")),
        "cmte_dsgn": _choose("c", ("P", "A")),
        "linkage_id": f"case when {sc} % 11 = 0 then ' ' || {link} else {link} end",
        "cycle": "y",
    }


def _weball() -> dict[str, str]:
    return {
        "cand_id": _id8("H", "c"),
        "cand_name": "'CANDIDATE ' || cast(c as string)",
        "cand_ici": _choose("c", ("I", "C", "O")),
        "pty_cd": "cast(c % 3 + 1 as string)",
        "cand_pty_affiliation": _choose("c", ("DEM", "REP", "LIB")),
        "ttl_receipts": "case when c % 29 = 0 then '' else cast(s as string) end",
        "trans_from_auth": "cast(mn as string)",
        "ttl_disb": "cast(mx as string)",
        "trans_to_auth": "cast(n as string) || '.5'",
        "coh_bop": "cast(s - mx as string)",
        "coh_cop": "' ' || cast(s - mn as string)",
        "cand_contrib": "cast(n * 100 as string)",
        "cand_loans": "'0'",
        "other_loans": "''",
        "cand_loan_repay": "'0.00'",
        "other_loan_repay": "' 12.345 '",
        "debts_owed_by": "cast(mx - mn as string)",
        "ttl_indiv_contrib": "cast(s as string)",
        "cand_office_st": _choose("c", ("CA", "NY", "TX", "FL")),
        "cand_office_district": "lpad(cast(c % 53 as string), 2, '0')",
        "spec_election": "''",
        "prim_election": _choose("c", ("W", "L")),
        "run_election": "''",
        "gen_election": _choose("n", ("W", "L")),
        "gen_election_precent": "cast(n % 100 as string) || '.' || lpad(cast(c % 100000 as string), 5, '0')",
        "other_pol_cmte_contrib": "cast(mn as string)",
        "pol_pty_contrib": "case when c % 7 = 0 then 'n/a' else '0' end",
        "cvg_end_dt": f"case when c % 2 = 0 then {_slash('last_d')} else {_mmddyyyy('last_d')} end",
        "indiv_refunds": "'0'",
        "cmte_refunds": "''",
        "cycle": "y",
    }


# ------------------------------------------------------------- relations

def _ccl_base_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", cycle_of("o_orderdate").alias("y"))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("l_suppkey").alias("s"), F.col("o_custkey").alias("c"), "y")
            .distinct())


_CCL_BASE_SQL = ("(select distinct l_suppkey as s, o_custkey as c,"
                 " cast(year(o_orderdate) + year(o_orderdate) % 2 as int) as y"
                 " from lineitem join orders on l_orderkey = o_orderkey)")


def _weball_base_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    amt = F.col("o_totalprice").cast("decimal(14,2)")
    return (od.groupBy(F.col("o_custkey").alias("c"), cycle_of("o_orderdate").alias("y"))
            .agg(F.sum(amt).alias("s"), F.min(amt).alias("mn"), F.max(amt).alias("mx"),
                 F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last_d")))


_WEBALL_BASE_SQL = ("(select o_custkey as c, cast(year(o_orderdate) + year(o_orderdate) % 2 as int) as y,"
                    " sum(cast(o_totalprice as decimal(14,2))) as s, min(cast(o_totalprice as decimal(14,2))) as mn,"
                    " max(cast(o_totalprice as decimal(14,2))) as mx, count(*) as n, max(o_orderdate) as last_d"
                    " from orders group by 1, 2)")


@dataclass(frozen=True)
class StandIn:
    columns: Callable[[], dict[str, str]]
    spark_base: Callable[[SparkSession, str], DataFrame]
    sql_base: str


def _plain(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: table(spark, sf_dir, name)


STANDINS: dict[str, StandIn] = {
    "indiv": StandIn(_indiv, _plain("orders"), "orders"),
    "oth": StandIn(_oth, _plain("orders"), "orders"),
    "pas2": StandIn(_pas2, _plain("lineitem"), "lineitem"),
    "oppexp": StandIn(_oppexp, _plain("lineitem"), "lineitem"),
    "indexp": StandIn(_indexp, _plain("lineitem"), "lineitem"),
    "cm": StandIn(_cm, _plain("customer"), "customer"),
    "cn": StandIn(_cn, _plain("supplier"), "supplier"),
    "ccl": StandIn(_ccl, _ccl_base_spark, _CCL_BASE_SQL),
    "weball": StandIn(_weball, _weball_base_spark, _WEBALL_BASE_SQL),
}
SHUFFLED = ("ccl", "weball")        # joined or grouped rows; the others are one scan


def _ordered(ft: str) -> list[tuple[str, str]]:
    cols = STANDINS[ft].columns()
    names = schemas.column_names(ft) + ["cycle"]
    missing = [n for n in names if n not in cols]
    if missing:
        raise AssertionError(f"stand-in {ft} lacks {missing}")
    return [(n, cols[n]) for n in names]


# Spark's upper() goes through ICU, at several microseconds a text; ASCII needs no more than its letters.
_ASCII_UPPER = (r"(case when \1 rlike '[^ -~]' then upper(\1)"
                r" else translate(\1, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') end)")
# A column (a short one) that is bound by a lambda. Spark makes one method of a projection
# of these widths, which is too long for the JVM to compile and so is interpreted; with a
# lambda in it, a projection is made in many methods.
_BOUND = "entity_tp"


def _column(e: str, name: str) -> Column:
    value = F.expr(re.sub(r"\bupper\((\w+)\)", _ASCII_UPPER, e))
    return (let(value, lambda x: x) if name == _BOUND else value).alias(name)


def raw(spark: SparkSession, sf_dir: str, ft: str, by_cycle: bool = False) -> DataFrame:
    """All-string raw rows of one file type (plus the integer ``cycle``). ``by_cycle``: in
    the order of cycles inside each task, as ``parquet.write_raw`` wants them; the narrow
    rows of the base are sorted for that and not the raw rows."""
    spec = STANDINS[ft]
    base, cols = spec.spark_base(spark, sf_dir), _ordered(ft)
    if by_cycle:
        base = base.sortWithinPartitions(F.expr(dict(cols)["cycle"]))
    return base.select(*[_column(e, n) for n, e in cols])


def raw_sql(ft: str) -> str:
    spec = STANDINS[ft]
    body = ", ".join(f'{e} as "{n}"' for n, e in _ordered(ft))
    return f"select {body} from {spec.sql_base}"


# -------------------------------------------------- probe log, docs, http

_PROBE_COLS = {
    "probe_id": "event_id",
    "checked_at": "ts",
    "file_type": "case user_id % 9 " + " ".join(
        f"when {i} then '{ft}'" for i, ft in enumerate(PROBE_FILE_TYPES[:-1])) + f" else '{PROBE_FILE_TYPES[-1]}' end",
    "cycle": "cast(2000 + 2 * ((user_id - user_id % 9) / 9) as int)",
    "status_code": ("cast(case when event_type = 'error' then (case when event_id % 3 = 0 then 503 else 404 end)"
                    " else 200 end as int)"),
    "etag": ("case when event_type = 'error' then NULL"
             " when event_type in ('view', 'click') then 'W/\"a\"' else 'W/\"b\"' end"),
    "last_modified": "case when event_type = 'error' then NULL else cast(cast(ts as date) as string) end",
    "content_length": "case when event_type = 'error' then NULL else 1000 + (event_id % 97) * 10 end",
}


def probe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per probe: the events table read as an append-only probe log."""
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {n}" for n, e in _PROBE_COLS.items()])


def probe_log_sql() -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in _PROBE_COLS.items()) + " from events"


_DOC_COLS = {
    "doc_id": "doc_id",
    "rel_path": "'docs/' || source || '/' || cast(doc_id as string) || '.md'",
    # Every fifth document has no heading line, so its title falls back to
    # the file name and its summary is empty.
    "content": "case when doc_id % 5 = 0 then text else '# ' || source || chr(10) || chr(10) || text end",
}


def doc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as markdown files: a heading line, a blank line, then the text."""
    return table(spark, sf_dir, "documents").selectExpr(*[f"{e} as {n}" for n, e in _DOC_COLS.items()])


def doc_table_sql() -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in _DOC_COLS.items()) + " from documents"


_HTTP_COLS = {
    "fetched_at": "'2024-01-' || lpad(cast(page_id % 28 + 1 as string), 2, '0') || 'T00:00:00'",
    "url": "url",
    "status_code": "cast(case when page_id % 10 = 0 then 404 else 200 end as int)",
    "content": "html",
}


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 1) -> DataFrame:
    """The probe log as a stream over the table's own file or folder of files."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    # The file source wants a folder or a pattern; this pattern is either.
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(f"{sf_dir.rstrip('/')}/events.parque[t]"))
    return source.selectExpr(*[f"{e} as {n}" for n, e in _PROBE_COLS.items()])


def http_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched web records (fetched_at, url, status_code, content) from ``pages``."""
    return table(spark, sf_dir, "pages").selectExpr(*[f"{e} as {n}" for n, e in _HTTP_COLS.items()])


def http_records_sql() -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in _HTTP_COLS.items()) + " from pages"
