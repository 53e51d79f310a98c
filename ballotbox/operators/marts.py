"""Cross-cycle unions and marts.

Scale notes
* Every aggregate is a hash aggregate with a map-side partial step, so a hot
  committee (even a third of all rows) is reduced inside each map task before
  the shuffle; only one row per (key, task) crosses the network.
* The candidate mart joins *after* aggregating contributions per committee:
  the big side is reduced to one row per (committee, cycle) before any join.
  No broadcast hint is given: Spark broadcasts a side only when its measured
  size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at
  runtime) and falls back to a sort-merge join beyond it.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.operators.staging import stage
from ballotbox.session import scratch_path
from ballotbox.sources.parquet import read_raw

TOTAL_TYPE = "decimal(38,2)"


def union_cycles(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL of per-cycle frames by column name; duplicates are kept."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_cycles needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)


def all_cycles(spark: SparkSession, root: str, file_type: str, cycles: Iterable[int | None] | None = None,
               strict: bool = False) -> DataFrame:
    """The staged model of a file type over every cycle stored below ``root`` (or the listed ones).

    The cycles are the partitions found when it is called, so one loaded later
    belongs to it; the ``cycle`` filter is a partition filter, so unlisted cycles
    are never read.
    """
    raw = read_raw(spark, root, file_type, cycles)
    return stage(raw.select(*schemas.column_names(file_type), "cycle"), file_type, strict)


def committee_totals(stg_indiv: DataFrame) -> DataFrame:
    """Contributions per committee and cycle."""
    return (stg_indiv.groupBy("cmte_id", "cycle")
            .agg(F.count(F.lit(1)).alias("n_contributions"),
                 F.count("transaction_amt").alias("n_amounts"),
                 F.sum("transaction_amt").cast(TOTAL_TYPE).alias("total_amt"),
                 F.min("transaction_dt").alias("first_dt"),
                 F.max("transaction_dt").alias("last_dt")))


def candidate_receipts(stg_indiv: DataFrame, stg_ccl: DataFrame, stg_cn: DataFrame) -> DataFrame:
    """Receipts of each candidate's linked committees, per cycle.

    A committee linked to several candidates counts for each of them.
    """
    totals = (stg_indiv.groupBy("cmte_id", "cycle")
              .agg(F.sum("transaction_amt").alias("total_amt")))
    links = stg_ccl.select("cand_id", "cmte_id", "cycle").distinct()     # several linkage rows are one link
    per_cand = (links.join(totals, ["cmte_id", "cycle"])
                .groupBy("cand_id", "cycle")
                .agg(F.count(F.lit(1)).alias("n_committees"),
                     F.sum("total_amt").cast(TOTAL_TYPE).alias("total_receipts")))
    names = stg_cn.groupBy("cand_id").agg(F.max("cand_name").alias("cand_name"))
    return per_cand.join(names, "cand_id", "left")


def committee_profile(stg_indiv: DataFrame, stg_cm: DataFrame) -> DataFrame:
    """Committee totals with the committee's master record.

    The master table holds a row per committee and cycle; each committee's
    latest record (``max(struct(cycle, ...))``, a partial aggregate) names it,
    so the join is on the committee alone and one-to-one.
    """
    master = (stg_cm.groupBy("cmte_id")
              .agg(F.max(F.struct("cycle", "cmte_nm", "cmte_tp", "cmte_pty_affiliation")).alias("m"))
              .select("cmte_id", F.col("m.cmte_nm").alias("cmte_nm"), F.col("m.cmte_tp").alias("cmte_tp"),
                      F.col("m.cmte_pty_affiliation").alias("cmte_pty_affiliation")))
    totals = (stg_indiv.groupBy("cmte_id", "cycle")
              .agg(F.count(F.lit(1)).alias("n_contributions"),
                   F.sum("transaction_amt").cast(TOTAL_TYPE).alias("total_amt")))
    return totals.join(master, "cmte_id", "left")


# ---- the star of candidates, links, committees and contributions on co-located storage

STAR_KEYS = ("cmte_id", "cycle")


def store_bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``STAR_KEYS``: one exchange now, none in
    the joins and aggregates on these keys later."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, *STAR_KEYS).write.bucketBy(buckets, *STAR_KEYS).sortBy(*STAR_KEYS)
     .option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table))
    return spark.table(table)


def daily_totals(stg_indiv: DataFrame) -> DataFrame:
    """Contributions per committee, cycle and day: the star's fact. Summed before it is
    dealt to buckets, so a committee that holds a third of all contributions has a row
    per day in its bucket like any other."""
    return (stg_indiv.groupBy(*STAR_KEYS, "transaction_dt")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("transaction_amt").alias("amt")))


def store_star(stg_indiv: DataFrame, stg_cm: DataFrame, stg_ccl: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored facts, committees (one row per committee and cycle) and links."""
    committees = stg_cm.groupBy(*STAR_KEYS).agg(F.max(F.struct("cmte_nm", "cmte_tp")).alias("m")).select(
        *STAR_KEYS, "m.cmte_nm", "m.cmte_tp")
    links = stg_ccl.select("cand_id", *STAR_KEYS).distinct()
    return (store_bucketed(daily_totals(stg_indiv), "star_days", buckets), store_bucketed(committees, "star_committees", buckets),
            store_bucketed(links, "star_links", buckets))


def linked_totals(days: DataFrame, committees: DataFrame, links: DataFrame) -> DataFrame:
    """What each committee of a candidate received in a cycle, without an exchange."""
    totals = days.groupBy(*STAR_KEYS).agg(
        F.sum("n").alias("n_contributions"), F.sum("amt").cast(TOTAL_TYPE).alias("total_amt"),
        F.min("transaction_dt").alias("first_dt"), F.max("transaction_dt").alias("last_dt"))
    return links.join(totals, list(STAR_KEYS)).join(committees, list(STAR_KEYS), "left")


def candidate_star(days: DataFrame, committees: DataFrame, links: DataFrame, stg_cn: DataFrame) -> DataFrame:
    """``linked_totals`` with the candidate's name."""
    names = stg_cn.groupBy("cand_id").agg(F.max("cand_name").alias("cand_name"))
    return linked_totals(days, committees, links).join(names, "cand_id", "left")


ROLLUP = ("party", "office", "cycle")
ROLLUP_SETS = (("party", "office", "cycle"), ("party", "cycle"), ("party", "office"), ("party",), ("cycle",), ())


def receipts_rollup(receipts: DataFrame, stg_cn: DataFrame) -> DataFrame:
    """Receipts of candidates by party, office and cycle, with subtotals. A candidate
    without a record has no party, which is not the subtotal over parties: ``all_<key>``
    is 1 where a row is over all values of the key."""
    who = (stg_cn.groupBy("cand_id").agg(F.max(F.struct("cycle", "cand_pty_affiliation", "cand_office")).alias("m"))
           .select("cand_id", F.col("m.cand_pty_affiliation").alias("party"), F.col("m.cand_office").alias("office")))
    rows = receipts.join(who, "cand_id", "left")
    return (rows.groupingSets([[F.col(c) for c in s] for s in ROLLUP_SETS], *ROLLUP)
            .agg(*[F.grouping(c).cast("int").alias(f"all_{c}") for c in ROLLUP],
                 F.count(F.lit(1)).alias("n_candidates"), F.sum("total_receipts").cast(TOTAL_TYPE).alias("total_receipts")))
