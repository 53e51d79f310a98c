"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox.session import scratch_path

# Fixed value: a word is a run of anything but space, tab, line feed, vertical
# tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str, share: int = 1) -> DataFrame:
    """Write below the shared scratch folder and read again: what follows starts
    from files that survive a lost executor, and nothing above runs twice.
    ``share``: results so many times smaller than the shuffled input go into so
    many times fewer files than there are shuffle partitions."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if share > 1:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // share))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Computed once and held on the executors' disks. For results that follow from
    written tables in a few steps: parts lost with an executor are computed again."""
    return df.persist(StorageLevel.DISK_ONLY)


def n_words(text: Column) -> Column:
    """Words of a text (NULL: 0) as a long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart; equal rows share it."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def pieces(batches, max_bytes: int = 8 << 20, column: str = "text"):
    """Cut Arrow batches into slices of at most ``max_bytes`` of text (one row at
    least), so that a run of very long texts does not fill a worker."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + (n or 0) > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if len(sizes) > start:
            yield batch.slice(start)
