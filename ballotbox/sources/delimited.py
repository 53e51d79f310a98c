"""Pipe-delimited raw files (S1): positional schema, every column a string.

A file is read as lines (ended by ``\\n``; a ``\\r`` before it is dropped, any
other is text) and each line is split at every ``|``: bulk filing text is not
quoted, so a ``"`` is a character like any other. Lines with another number of
fields than the layout are not parsed but kept as they are in ``rejects``. The
read is splittable, so a large text file is scanned by many tasks.

An empty field is NULL, whether it comes from a text file or out of an archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox import schemas

# Encodings in which a line ends at the byte of "\n".
ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")
# Zstandard for text files (``.zstd``): the codec of Spark's Parquet, which needs no native Hadoop.
ZSTD = "org.apache.parquet.hadoop.codec.ZstandardCodec"
# A compressed file is read by one task: as many lines of ~200 bytes are some 50 MB of it.
MAX_LINES_PER_FILE = 1_000_000


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Lines of a file, folder or ``<ft>/cycle=YYYY/`` tree: value (and cycle). Lines are
    cut at the byte ``\\n`` and decoded after that, so only encodings of ``ENCODINGS`` can
    be read; another is an error."""
    if encoding.upper() not in ENCODINGS:
        raise ValueError(f"no text files in {encoding}; known: {', '.join(ENCODINGS)}")
    lines = spark.read.option("lineSep", "\n").option("io.compression.codecs", ZSTD).text(path)
    if encoding.upper() != "UTF-8":     # the reader hands the bytes on as they are
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding.upper()))
    value = F.col("value")          # few files have a \r at all, and the pattern would go over every line
    return lines.withColumn("value", F.when(value.endswith("\r"), F.regexp_replace(value, "\r$", "")).otherwise(value))


def n_fields(value: str | Column = "value") -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.octet_length(v) - F.octet_length(F.replace(v, F.lit("|"), F.lit(""))) + 1


def counted(lines: DataFrame) -> DataFrame:
    """Lines with their number of fields, which is not counted again where it is known."""
    return lines if "n_fields" in lines.columns else lines.withColumn("n_fields", n_fields().cast("int"))


def parse(lines: DataFrame, file_type: str) -> DataFrame:
    """Raw columns of the lines that have the layout's number of fields."""
    others = [c for c in lines.columns if c not in ("value", "n_fields")]
    good = counted(lines).where(F.col("n_fields") == schemas.width(file_type))
    return good.select(*split_line("value", file_type), *others)


def rejects(lines: DataFrame, file_type: str) -> DataFrame:
    """The other lines, whole, with their number of fields."""
    return counted(lines).where(F.col("n_fields") != schemas.width(file_type))


def read_raw(spark: SparkSession, path: str, file_type: str, encoding: str = "UTF-8") -> DataFrame:
    """``path`` as raw strings; see ``rejects`` for the lines it leaves out."""
    return parse(read_lines(spark, path, encoding), file_type)


def line_of(cols: list[str]) -> Column:
    """One delimited line."""
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in cols])


def to_lines(df: DataFrame, cols: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(line_of(cols).alias("value"), *extra)


def write_lines(lines: DataFrame, path: str, partition_by: str | None = "cycle", compressed: bool = False) -> str:
    """``compressed``: a quarter of the bytes, in files of a bounded number of lines."""
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if compressed:
        writer = (writer.option("compression", ZSTD).option("parquet.compression.codec.zstd.level", 1)
                  .option("maxRecordsPerFile", MAX_LINES_PER_FILE))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)
    return path


def write_raw_text(df: DataFrame, path: str, file_type: str, partition_by: str | None = "cycle") -> str:
    """Write raw rows as pipe-delimited text, one folder per cycle."""
    extra = (partition_by,) if partition_by else ()
    return write_lines(to_lines(df, schemas.column_names(file_type), extra=extra), path, partition_by)


def split_line(value: str | Column, file_type: str) -> list[Column]:
    """Split a line into the positional columns; empty and missing fields are NULL."""
    v = F.col(value) if isinstance(value, str) else value
    parts = F.split(v, r"\|", -1)           # Java cuts at an escaped character without a pattern
    return [F.nullif(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).alias(name)
            for i, name in enumerate(schemas.column_names(file_type))]
