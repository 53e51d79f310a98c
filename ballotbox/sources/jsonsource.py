"""JSON records (S6): typed reads of JSON lines and JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fetched-record table: four columns.
HTTP_SCHEMA = T.StructType([
    T.StructField("fetched_at", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("content", T.StringType()),
])


def _parsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    from ballotbox.sources.sinks import JSON_EXACT

    options = {**JSON_EXACT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    with_bad = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    # partition folders of the path come as columns of their own
    found = [f.name for f in schema.fields if f.name in lines.columns]
    return lines.select("value", *found, F.from_json("value", with_bad, options).alias("r"))


def read_json(spark: SparkSession, path: str, schema: T.StructType = HTTP_SCHEMA) -> DataFrame:
    """JSON lines with a declared schema (no inference pass over the data). Lines
    that are no such record are left out; ``json_rejects`` has them."""
    df = _parsed(spark, path, schema)
    return df.where("r._malformed IS NULL").select(*[
        (F.col(f.name) if f.name in df.columns else F.col(f"r.{f.name}")).cast(f.dataType).alias(f.name) for f in schema.fields])


def json_rejects(spark: SparkSession, path: str, schema: T.StructType = HTTP_SCHEMA) -> DataFrame:
    """The lines that ``read_json`` leaves out, whole."""
    return _parsed(spark, path, schema).where("r._malformed IS NOT NULL").select("value")


def parse_json(c: str | Column, schema: T.StructType | str) -> Column:
    """A JSON text column as a struct; malformed text gives NULL fields."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema)


def append_table(df: DataFrame, path: str) -> str:
    """Append a batch of records; the first append creates the table."""
    df.write.mode("append").parquet(path)
    return path


def load_http_source(spark: SparkSession, json_path: str, table_path: str) -> DataFrame:
    """Fetched JSON records appended to the record table; returns the table."""
    append_table(read_json(spark, json_path), table_path)
    return spark.read.parquet(table_path)
