"""Ordered probe logic on a stream in event time.

The watermark says which part of the log is complete; what is complete is
answered once and for good, whatever order the probes came in.

* ``detect_stream`` (M4): probes are gathered per key and hour by Spark's windowed
  aggregation, which a hot key spreads over its hours. A closed hour holds its
  probes in order, so all its answers but the first probe's follow there, with
  array functions. A stateful processor per key keeps the last probe in value
  state; it takes the closed hours as an iterator, hands each on as it comes and
  keeps only their heads (first and last probe) to answer the first probes, in
  time order.
* ``missed_stream`` (M9): a processor per key of the target grid, with an event-time
  timer at the end of each day. The timer fires when the watermark passes it, so a
  collector that has stopped is reported without a new row of its key.
* ``outage_stream`` (M11): session windows over the failed probes.

The watermark follows the greatest time of any key. ``Clock`` adds the run's own time
to the stream, so that the last hours and days close when a run ends. Probes
behind the watermark are late: Spark drops them from the windows, and
``late_probes`` finds them as those of the append-only log without an answer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ballotbox.functions.normalize import epoch_micros, from_epoch_micros
from ballotbox.operators.probes import KEYS, OK_STATUS

# Fixed value: the store that several states of one processor need.
STORE = ("spark.sql.streaming.stateStore.providerClass",
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
DELAY = "1 hour"
KEY = "file"                    # the key as one value that is never NULL, since a processor tells NULL keys apart row by row
DAY_MS = 86_400_000
PROBE = ("us", "probe_id", "status_code", "etag", "last_modified")
KINDS = {"us": "bigint", "probe_id": "bigint", "status_code": "int", "etag": "string", "last_modified": "string",
         "changed": "boolean"}


class Clock:
    """The run's own time as rows of the stream, from a folder of its own."""

    SCHEMA = "tick_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows([]).write.mode("append").parquet(path)       # the folder must be there

    def _rows(self, times: list) -> DataFrame:
        return self.spark.createDataFrame([(t,) for t in times], "tick_at timestamp_ntz").select(
            F.col("tick_at").cast("timestamp").alias("tick_at"))

    def tick(self, at: dt.datetime) -> None:
        """``at``: UTC wall clock."""
        self._rows([at]).coalesce(1).write.mode("append").parquet(self.path)

    def joined(self, probes: DataFrame, delay: str) -> DataFrame:
        """``probes`` and the ticks, with the watermark on ``at``; ``tick`` tells them apart."""
        ticks = self.spark.readStream.schema(self.SCHEMA).parquet(self.path)
        log = probes.select("*", F.col("checked_at").cast("timestamp").alias("at"), F.lit(False).alias("tick"))
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in probes.schema]
        return log.unionAll(ticks.select(*empty, F.col("tick_at").alias("at"), F.lit(True).alias("tick"))).withWatermark("at", delay)


def run(spark: SparkSession, stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Everything available, in micro-batches, appended to parquet; goes on from its checkpoint."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        q = (stream.writeStream.format("parquet").outputMode("append").option("path", out_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_closed(spark: SparkSession, make: Callable[[], DataFrame], clock: Clock, until: dt.datetime | None, out_path: str,
               checkpoint: str) -> DataFrame:
    """All that is available, then (from the checkpoint) the run's own time ``until``,
    which closes what lies before it less the delay; returns what is closed."""
    run(spark, make(), out_path, checkpoint)
    if until is not None:
        clock.tick(until)
        run(spark, make(), out_path, checkpoint)
    return spark.read.schema(make().schema).parquet(out_path)


def _key() -> Column:
    return F.to_json(F.struct(*KEYS)).alias(KEY)


def _key_columns() -> list[Column]:
    parts = F.from_json(KEY, "file_type string, cycle int")
    return [parts[k].alias(k) for k in KEYS]


def _differs(a: Column, b: Column) -> Column:
    return ~a["etag"].eqNullSafe(b["etag"]) | ~a["last_modified"].eqNullSafe(b["last_modified"])


def _closed_hours(log: DataFrame, span: str) -> DataFrame:
    """Per key and closed ``span``: the first and the last probe (``f_*``, ``l_*``) and, as
    arrays, the probes after the first with their answers."""
    probe = F.struct(epoch_micros("checked_at").alias("us"), "probe_id", "status_code", "etag", "last_modified")
    # ticks go by the aggregate's result: a filter on the rows would be moved below the watermark
    hours = (log.groupBy(*KEYS, F.window("at", span)).agg(F.array_sort(F.collect_list(F.when(~F.col("tick"), probe))).alias("p"))
             .filter(F.size("p") > 0))
    n = F.size("p")
    rest = F.slice("p", F.lit(2), F.greatest(n - 1, F.lit(0)))
    changed = F.zip_with(F.slice("p", F.lit(1), F.greatest(n - 1, F.lit(0))), rest,
                         lambda a, b: F.coalesce((b["status_code"] == OK_STATUS) & _differs(a, b), F.lit(False)))
    first, last = F.element_at("p", 1), F.element_at("p", -1)
    return hours.select(
        _key(), *[first[c].alias(f"f_{c}") for c in PROBE], *[last[c].alias(f"l_{c}") for c in PROBE],
        *[rest[c].alias(c) for c in PROBE], changed.alias("changed"))


def _same(a, b) -> bool:
    return pd.isna(a) and pd.isna(b) or (not pd.isna(a) and not pd.isna(b) and a == b)


class Changes(StatefulProcessor):
    """Closed hours of a key -> arrays of probes with their answers."""

    LAST = "etag string, last_modified string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.LAST)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        heads = []
        columns = [*PROBE, "changed"]
        for hours in rows:
            heads.append(hours[[*(f"f_{c}" for c in PROBE), "l_etag", "l_last_modified"]])
            some = hours[hours["us"].map(len) > 0]
            if len(some):
                yield some[[KEY, *columns]]
        heads = pd.concat(heads).sort_values(["f_us", "f_probe_id"])        # one row per hour
        last = self.last.get() if self.last.exists() else None
        changed = []
        for h in heads.itertuples(index=False):
            changed.append(last is not None and h.f_status_code == OK_STATUS
                           and not (_same(last[0], h.f_etag) and _same(last[1], h.f_last_modified)))
            last = (None if pd.isna(h.l_etag) else h.l_etag, None if pd.isna(h.l_last_modified) else h.l_last_modified)
        self.last.update(last)
        firsts = {c: [[None if pd.isna(x) else x for x in heads[f"f_{c}"].tolist()]] for c in PROBE}
        firsts["status_code"] = [[None if x is None else int(x) for x in firsts["status_code"][0]]]
        yield pd.DataFrame({KEY: [key[0]], **firsts, "changed": [changed]})

    def close(self) -> None:
        pass


def detect_stream(probes: DataFrame, clock: Clock, delay: str = DELAY, span: str = "1 hour") -> DataFrame:
    """M4: per probe ``changed``, once its hour has closed; equals the batch answer of all
    probes that were not late. ``span`` bounds what is gathered of one key."""
    schema = f"{KEY} string, " + ", ".join(f"{c} array<{KINDS[c]}>" for c in (*PROBE, "changed"))
    answered = _closed_hours(clock.joined(probes, delay), span).groupBy(KEY).transformWithStateInPandas(
        Changes(), schema, "append", "None")
    flat = answered.select(*_key_columns(), F.inline(F.arrays_zip(*PROBE, "changed")))
    return flat.select("probe_id", from_epoch_micros("us").alias("checked_at"), *KEYS, "status_code", "etag",
                       "last_modified", "changed")


def late_probes(log: DataFrame, answered: DataFrame, key: str = "probe_id") -> DataFrame:
    """Probes of the (append-only) log that came behind the watermark: those without an answer."""
    return log.join(answered.select(key), key, "left_anti")


class MissedDays(StatefulProcessor):
    """Days of a key of the grid that the watermark has passed and that have no probe.
    State: the first day not yet answered, and the days from it on that have one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "day int")
        self.seen = handle.getMapState("seen", "day int", "there boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        day = int(initialState["start_day"].min())
        self.next.update((day,))
        self.handle.registerTimer((day + 1) * DAY_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.next.exists():                      # a key of the grid
            first = self.next.get()[0]
            for chunk in rows:
                for day in chunk["day"].unique().tolist():
                    if day >= first:
                        self.seen.updateValue((int(day),), (True,))
        else:
            for _ in rows:
                pass
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, until = self.next.get()[0], timerValues.getCurrentWatermarkInMs() // DAY_MS
        if until <= first:
            return
        missed = []
        for day in range(first, until):
            if self.seen.containsKey((day,)):
                self.seen.removeKey((day,))
            else:
                missed.append(day)
        self.next.update((until,))
        self.handle.registerTimer((until + 1) * DAY_MS)
        if missed:
            yield pd.DataFrame({KEY: key[0], "day": pd.Series(missed, dtype="int32")})

    def close(self) -> None:
        pass


def missed_stream(probes: DataFrame, clock: Clock, grid: DataFrame, start: dt.date, delay: str = DELAY) -> DataFrame:
    """M9 on the stream: days from ``start`` on without a probe of a key of ``grid``, each
    reported once the watermark has passed its end."""
    first = (start - dt.date(1970, 1, 1)).days
    keys = grid.select(_key()).distinct().withColumn("start_day", F.lit(first)).groupBy(KEY)
    log = clock.joined(probes, delay).select(_key(), "at", F.unix_date(F.to_date("at")).alias("day"))
    found = log.groupBy(KEY).transformWithStateInPandas(MissedDays(), f"{KEY} string, day int", "append", "EventTime", keys)
    return found.select(*_key_columns(), F.date_from_unix_date("day").alias("missed_date"), F.lit("backfill").alias("source"))


def outage_stream(probes: DataFrame, clock: Clock, gap: str, delay: str = DELAY) -> DataFrame:
    """M11 on the stream: failed probes of a key no more than ``gap`` apart are one outage,
    reported when the watermark has passed its end by ``gap``."""
    failed = clock.joined(probes, delay).filter(F.col("tick") | ~F.coalesce(F.col("status_code") == OK_STATUS, F.lit(False)))
    return (failed.groupBy(*KEYS, F.session_window("at", gap))
            .agg(F.min("checked_at").alias("outage_start"), F.max("checked_at").alias("outage_end"),
                 F.count_if(~F.col("tick")).alias("n_failed_probes"))
            .filter(F.col("n_failed_probes") > 0).select(*KEYS, "outage_start", "outage_end", "n_failed_probes"))


def late_failures(log: DataFrame, outages: DataFrame) -> DataFrame:
    """Failed probes of the log outside every reported outage of their key: behind the
    watermark when they came (or not yet closed, while the stream goes on)."""
    spans = outages.select(*[F.col(k).alias(f"o_{k}") for k in KEYS], "outage_start", "outage_end")
    failed = log.filter(~F.coalesce(F.col("status_code") == OK_STATUS, F.lit(False)))
    inside = [failed[k].eqNullSafe(spans[f"o_{k}"]) for k in KEYS]
    inside.append(F.col("checked_at").between(F.col("outage_start"), F.col("outage_end")))
    return failed.join(spans, inside, "left_anti")
