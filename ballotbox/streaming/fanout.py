"""Streaming append and fan-out (M1 and S7 on a stream) with ``foreachBatch``.

Each micro-batch is written to every sink into its own ``batch=<epoch id>``
folder with dynamic partition overwrite. A batch replayed after a failure
(the checkpoint records progress only after the batch function returns)
rewrites the same folder instead of appending a second copy, so the sinks
stay exactly-once without a transactional table format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox.sources.sinks import Sink, write_all


def _batch_writer(sinks: list[Sink]):
    def write(batch: DataFrame, epoch_id: int) -> None:
        tagged = batch.withColumn("batch", F.lit(epoch_id).cast("long"))
        write_all(tagged, [Sink(s.fmt, s.path, "overwrite",
                                {**s.options, "partitionOverwriteMode": "dynamic"}) for s in sinks],
                  partition_by=("batch",))
    return write


def append_stream(spark: SparkSession, stream: DataFrame, sinks: list[Sink], checkpoint: str) -> None:
    """Run the stream over everything available, appending each batch to all sinks."""
    q = (stream.writeStream.foreachBatch(_batch_writer(sinks))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
