"""Change detection on a stream of probes (M4).

Probes arrive as a stream; per key (file_type, cycle) the state keeps the
latest probe seen: (time, probe id, etag, last_modified). Each micro-batch's
rows of a key are ordered by (time, probe id) and compared one after the
other, exactly as batch change detection does, so probes arriving in time
order give the batch answer. A probe older than the state's latest arrives
late: it is emitted with ``late = true`` and ``changed = false`` and does not
become the latest (its true answer depends on rows already answered).

State is a handful of fields per key. A micro-batch's rows of one key are
handled by one task; bound that with ``maxFilesPerTrigger`` /
``maxBytesPerTrigger`` on the source.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ballotbox.functions.normalize import epoch_micros, from_epoch_micros
from ballotbox.operators.probes import KEYS, OK_STATUS

OUTPUT_SCHEMA = ("probe_id long, file_type string, cycle int, checked_at_us long, status_code int, "
                 "etag string, last_modified string, changed boolean, late boolean")
STATE_SCHEMA = "last_us long, last_id long, etag string, last_modified string"


def _differs(now: pd.Series, before: pd.Series) -> pd.Series:
    """NULL equals NULL."""
    return ~((now == before) | (now.isna() & before.isna()))


def detect(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches), ignore_index=True).sort_values(["checked_at_us", "probe_id"], ignore_index=True)
    last_us, last_id, *tags = state.get if state.exists else (None, None, None, None)
    us, ids = rows["checked_at_us"], rows["probe_id"]
    late = (us < last_us) | ((us == last_us) & (ids < last_id)) if state.exists else pd.Series(False, index=rows.index)
    start = int(late.sum())                     # in order of time the late ones come first
    changed = pd.Series(False, index=rows.index)
    on_time = rows.iloc[start:]
    if len(on_time):
        differs = pd.Series(False, index=on_time.index)
        for name, tag in zip(("etag", "last_modified"), tags):
            now = on_time[name].astype(object)
            before = now.shift()
            before.iloc[0] = tag
            differs |= _differs(now, before)
        if not state.exists:
            differs.iloc[0] = False             # nothing to compare the first probe with
        changed.iloc[start:] = differs & (on_time["status_code"] == OK_STATUS)
        end = on_time.iloc[-1]
        state.update((int(end["checked_at_us"]), int(end["probe_id"]),
                      *(None if pd.isna(end[c]) else end[c] for c in ("etag", "last_modified"))))
    out = rows[["probe_id", "file_type", "cycle", "checked_at_us", "status_code", "etag", "last_modified"]].copy()
    out["changed"] = changed.astype(bool)
    out["late"] = late.astype(bool)
    yield out


def detect_stream(probes: DataFrame) -> DataFrame:
    """Streaming (or batch) probes -> per-probe ``changed`` and ``late``."""
    prepared = probes.select("probe_id", *KEYS, epoch_micros("checked_at").alias("checked_at_us"),
                             "status_code", "etag", "last_modified")
    return (prepared.groupBy(*KEYS)
            .applyInPandasWithState(detect, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.NoTimeout))


def with_wall_clock(df: DataFrame) -> DataFrame:
    """``checked_at_us`` back to a UTC wall-clock ``checked_at`` (timestamp_ntz)."""
    return df.withColumn("checked_at", from_epoch_micros("checked_at_us")).drop("checked_at_us")


def run_available_now(spark: SparkSession, stream: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Process everything available as a bounded series of micro-batches into parquet."""
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out_path)
