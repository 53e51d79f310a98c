"""Raw parquet per (file type, cycle): write (S3), scan (S4), preview.

Layout: ``<root>/<file type>/cycle=<YYYY>/part-*.parquet``. A rerun of one
cycle replaces only that cycle's folder (dynamic partition overwrite); old
cycles stay untouched. Reads filter on ``cycle`` and Spark prunes the other
folders before listing their files.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox.session import file_system, list_folder

# Fixed value: the folder that Spark gives to NULL.
NO_CYCLE = "__HIVE_DEFAULT_PARTITION__"
# Files stay near the 128 MiB split size at ~1 KB rows.
MAX_RECORDS_PER_FILE = 1_000_000


def write_raw(df: DataFrame, root: str, file_type: str, partition_by: str = "cycle") -> str:
    """Write (or rewrite) the cycles present in ``df``; other cycles are kept.

    The write sorts rows by cycle inside each task, so a task keeps one file open at
    a time, unless they come in that order: narrow rows sorted before they are made
    wide take a fraction of a task's memory. No shuffle is added, so a hot cycle is
    still written by every task that holds its rows.
    """
    path = f"{root.rstrip('/')}/{file_type}"
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy(partition_by)
       .parquet(path))
    return path


def read_raw(spark: SparkSession, root: str, file_type: str, cycles: Iterable[int | None] | None = None) -> DataFrame:
    """All cycles found (U2), or only the listed ones with partition pruning (S4);
    ``None`` in the list is the folder of rows without a cycle."""
    path = f"{root.rstrip('/')}/{file_type}"
    df = spark.read.option("basePath", path).parquet(path)
    if cycles is not None:
        listed = list(cycles)
        wanted = F.col("cycle").isin([c for c in listed if c is not None])
        df = df.where(wanted | F.col("cycle").isNull() if None in listed else wanted)
    return df


def list_cycles(spark: SparkSession, root: str, file_type: str) -> list[int | None]:
    """Cycles of a partitioned raw table, from its ``cycle=...`` folders (``None``:
    rows without one). A metadata listing (as Spark's partition discovery does),
    not a scan; a folder whose name is no cycle is an error."""
    cycles: list[int | None] = []
    for name, path, folder in list_folder(spark, f"{root.rstrip('/')}/{file_type}"):
        if not folder or not name.startswith("cycle="):
            continue
        value = name[len("cycle="):]
        if value != NO_CYCLE and not value.isdigit():
            raise ValueError(f"no election cycle: {path}")
        cycles.append(None if value == NO_CYCLE else int(value))
    return sorted(cycles, key=lambda c: (c is None, c))


def drop_cycle(spark: SparkSession, root: str, file_type: str, cycle: int) -> None:
    """Takes away what is stored of one cycle, if anything is."""
    fs, path = file_system(spark, f"{root.rstrip('/')}/{file_type}/cycle={cycle}")
    if fs.exists(path):
        fs.delete(path, True)


def changes_between(stored: DataFrame, reloaded: DataFrame) -> DataFrame:
    """What a rerun does to a table: its rows with ``change`` added, vanished or
    unchanged and, since tables keep duplicates, how many times (``n``). Multiset
    difference and intersection, so each side is counted once and compared by value."""
    same = [c for c in stored.columns]
    parts = (("added", reloaded.exceptAll(stored)), ("vanished", stored.exceptAll(reloaded)),
             ("unchanged", stored.intersectAll(reloaded)))
    out = None
    for name, rows in parts:
        counted = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).withColumn("change", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    return out


def register_cycle_views(spark: SparkSession, root: str, file_type: str, cycles: Iterable[int | None]) -> list[str]:
    """Expose each cycle as temp view ``raw_<ft>_<cycle>`` (a pruned scan)."""
    names = []
    for c in cycles:
        name = f"raw_{file_type}_{'none' if c is None else c}"
        read_raw(spark, root, file_type, [c]).createOrReplaceTempView(name)
        names.append(name)
    return names


def head(df: DataFrame, order_by: list[str | Column], n: int = 10) -> DataFrame:
    """First ``n`` rows in a fixed order (distributed top-k, no full sort)."""
    return df.orderBy(*order_by).limit(n)
