"""Sinks: fan one result out to several stores (S7) and export files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ballotbox.session import scratch_path


@dataclass(frozen=True)
class Sink:
    fmt: str                      # parquet | json | csv | orc
    path: str
    mode: str = "append"
    options: dict = field(default_factory=dict)


def write_all(df: DataFrame, sinks: list[Sink], partition_by: tuple[str, ...] = ()) -> list[str]:
    """Compute ``df`` once and write it to every sink.

    The first write is the computation: it goes to a parquet folder below the
    shared scratch folder, and every sink is written from there, so the frame is
    neither computed twice nor held in executors' memory, whatever its size. In a
    stream the same fan-out goes inside ``foreachBatch`` (``streaming.fanout``).
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "fan-out")
    df.write.parquet(staged)
    for s in sinks:
        opts = {**(JSON_EXACT if s.fmt == "json" else {}), **s.options}
        writer = spark.read.schema(df.schema).parquet(staged).write.mode(s.mode).options(**opts).format(s.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(s.path)
    return [s.path for s in sinks]


# JSON options that keep timestamps to the microsecond (the default text
# format stops at milliseconds).
JSON_EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# CSV options that keep text exactly: no whitespace trimming, multi-line
# values quoted, and NULL written as the marker \N so that an empty string
# reads back as '' and NULL as NULL.
CSV_EXACT = {
    "nullValue": "\\N",
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quoteAll": "false",
    "escape": '"',
    "multiLine": "true",
}


def export(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """A stable analyst file (csv with header, json lines or parquet)."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(**CSV_EXACT)
    elif fmt == "json":
        writer = writer.options(**JSON_EXACT)
    writer.format(fmt).save(path)
    return path


def read_export(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_EXACT)
    elif fmt == "json":
        reader = reader.options(**JSON_EXACT)
    return reader.format(fmt).load(path)
