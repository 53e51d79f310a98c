"""Data quality checks (Q1-Q8) as distributed aggregates.

A check returns the rows that break a rule, or a count of them, never a
sample. All row-level checks of a model (not null, accepted values,
expression) are evaluated in ONE aggregate pass (``count_if`` per check: a
global aggregate with a map-side partial, so each task sends one row). A
uniqueness check is one grouped aggregate; a hot value is collapsed by the
partial aggregation before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballotbox.sources.delimited import n_fields

# --- Fixed values: the checks declared for the staging models.
NOT_NULL = {
    "stg_indiv": ("cmte_id", "tran_id", "transaction_dt", "transaction_amt", "cycle"),
    "stg_cm": ("cmte_id", "cmte_nm", "cycle"),
    "stg_cn": ("cand_id", "cand_name", "cycle"),
    "stg_ccl": ("cand_id", "cmte_id", "cycle"),
    "stg_oth": ("cmte_id", "tran_id", "transaction_dt", "transaction_amt", "cycle"),
    "stg_pas2": ("cmte_id", "tran_id", "cand_id", "transaction_dt", "transaction_amt", "cycle"),
    "stg_oppexp": ("cmte_id", "tran_id", "transaction_dt", "transaction_amt", "cycle"),
    "stg_weball": ("cand_id", "cand_name", "ttl_receipts", "cycle"),
}
UNIQUE = {"stg_indiv": ("tran_id",), "stg_cm": ("cmte_id",), "stg_cn": ("cand_id",)}
ACCEPTED_VALUES = {
    "stg_indiv": {"cycle": (2024, 2022, 2020, 2018, 2016, 2014, 2012, 2010, 2008, 2006, 2004, 2002, 2000)},
}
ZIP_COLUMNS = {
    "stg_indiv": "zip_code", "stg_cm": "cmte_zip", "stg_cn": "cand_zip",
    "stg_oth": "zip_code", "stg_pas2": "zip_code", "stg_oppexp": "zip_code",
}
# The expression test reads: length(<zip>) <= 5 or <zip> is null.

MODELS = tuple(NOT_NULL)


@dataclass(frozen=True)
class Check:
    kind: str            # not_null | unique | accepted_values | expression_is_true
    column: str
    values: tuple = ()   # accepted values


def declared_checks(model: str) -> list[Check]:
    checks = [Check("not_null", c) for c in NOT_NULL.get(model, ())]
    checks += [Check("unique", c) for c in UNIQUE.get(model, ())]
    checks += [Check("accepted_values", c, v) for c, v in ACCEPTED_VALUES.get(model, {}).items()]
    if model in ZIP_COLUMNS:
        checks.append(Check("expression_is_true", ZIP_COLUMNS[model]))
    return checks


def zip_rule(c: str) -> Column:
    return (F.length(F.col(c)) <= 5) | F.col(c).isNull()


def _failing(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(list(check.values))      # NULL -> NULL -> passes
    if check.kind == "expression_is_true":
        return ~zip_rule(check.column)          # NULL result passes
    raise ValueError(check.kind)


def _report(df: DataFrame, model: str) -> DataFrame:
    return df.select(F.lit(model).alias("model"), "check_name", "column_name",
                     F.col("failures").cast("bigint").alias("failures"))


def run_checks(df: DataFrame, model: str, checks: list[Check] | None = None,
               unique_by: tuple[str, ...] = ()) -> DataFrame:
    """Q8: one report ``(model, check_name, column_name, failures)`` for a model.

    ``unique_by=('cycle',)`` reads uniqueness within each cycle instead of
    across all cycles (the declared reading).
    """
    checks = declared_checks(model) if checks is None else checks
    row_checks = [c for c in checks if c.kind != "unique"]
    parts = []
    if row_checks:
        labels = [f"{c.kind}|{c.column}" for c in row_checks]
        one = df.agg(*[F.count_if(_failing(c)).alias(f"f{i}") for i, c in enumerate(row_checks)])
        stacked = one.select(F.explode(F.array(*[
            F.struct(F.lit(lab.split("|")[0]).alias("check_name"), F.lit(lab.split("|")[1]).alias("column_name"),
                     F.col(f"f{i}").alias("failures"))
            for i, lab in enumerate(labels)])).alias("r")).select("r.*")
        parts.append(_report(stacked, model))
    for c in (c for c in checks if c.kind == "unique"):
        dups = duplicate_values(df, c.column, by=unique_by)
        parts.append(_report(dups.agg(F.count(F.lit(1)).alias("failures"))
                             .select(F.lit("unique").alias("check_name"), F.lit(c.column).alias("column_name"),
                                     "failures"), model))
    return reduce(DataFrame.unionByName, parts)


def duplicate_values(df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Q2: values held by more than one row (NULLs ignored)."""
    keys = [*by, column]
    return (df.where(F.col(column).isNotNull())
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def unexpected_values(df: DataFrame, column: str, accepted: tuple) -> DataFrame:
    """Q3: each value outside the accepted list with its row count (NULL passes)."""
    return (df.where(~F.col(column).isin(list(accepted)))
            .groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Q5: child rows whose key has no parent row (left anti join).

    The parent side is reduced to its distinct keys first; Spark broadcasts it
    only if its measured size is under the broadcast threshold.
    """
    return child.join(parent.select(key).distinct(), key, "left_anti")


def amendment_duplicates(df: DataFrame, key: str = "tran_id", amend: str = "amndt_ind") -> DataFrame:
    """Q6: repeated filings of one transaction, with the amendment codes seen.

    The code set per key is bounded by the handful of amendment codes.
    """
    return (df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.array_join(F.array_sort(F.collect_set(amend)), ",").alias("amendment_codes"))
            .where(F.col("n_rows") > 1))


def row_width(lines: DataFrame, expected: int, value: str = "value") -> DataFrame:
    """Q7: line count and lines whose field count differs from the layout.

    Fields = separators + 1, counted without splitting the line into an array.
    """
    width = n_fields(value).cast("int")
    return lines.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.count_if(width != expected).alias("n_bad_width"),
                     F.min(width).alias("min_width"), F.max(width).alias("max_width"))


def row_widths(lines: DataFrame, expected: dict[str, int], kind: str = "file_type", value: str = "value") -> DataFrame:
    """Q7 for lines of several layouts at once, told apart by ``kind``: one pass. Lines
    are counted by width first; the layout is looked up for those few counts, not for each line."""
    widths = F.create_map(*[x for k, n in expected.items() for x in (F.lit(k), F.lit(n))])
    counted = lines.groupBy(kind, n_fields(value).cast("int").alias("_found")).agg(F.count(F.lit(1)).alias("_n"))
    layout = F.element_at(widths, F.col(kind))
    return (counted.groupBy(kind, layout.alias("expected_width"))
            .agg(F.sum("_n").alias("n_lines"),
                 F.sum(F.when(F.col("_found") != layout, F.col("_n")).otherwise(0)).alias("n_bad_width"),
                 F.min("_found").alias("min_width"), F.max("_found").alias("max_width")))
