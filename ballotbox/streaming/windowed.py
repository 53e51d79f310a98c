"""Probe counts per event-time day and status over a stream (M12 per day).

No watermark: a probe may arrive any time after its day, and every one counts.
Each micro-batch is aggregated by itself and its counts are written into the
batch's own ``batch=<epoch>`` folder with dynamic partition overwrite, so a
replayed batch replaces what it wrote. The table is the sum over the batches.
``compact`` folds all finished batches into one folder when there are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox.operators.probes import status_label


def daily_status_counts(probes: DataFrame) -> DataFrame:
    """(day, status, n_probes) of a batch of probes."""
    return (probes.groupBy(F.to_date("checked_at").alias("day"), status_label().alias("status"))
            .agg(F.count(F.lit(1)).alias("n_probes")))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all batches written so far."""
    parts = spark.read.schema("day date, status string, n_probes long, batch long").parquet(path)
    return parts.groupBy("day", "status").agg(F.sum("n_probes").alias("n_probes"))


def compact(spark: SparkSession, path: str, to: str) -> DataFrame:
    """All finished batches as one folder below ``to`` (for use between two runs of the stream)."""
    totals(spark, path).withColumn("batch", F.lit(-1).cast("long")).write.mode("overwrite").partitionBy("batch").parquet(to)
    return totals(spark, to)


def run_available_now(spark: SparkSession, probes: DataFrame, path: str, checkpoint: str) -> DataFrame:
    def write(batch: DataFrame, epoch_id: int) -> None:
        (daily_status_counts(batch).withColumn("batch", F.lit(epoch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))

    q = (probes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return totals(spark, path)
