"""Probe log analytics (M1-M12) as set operations over the whole log.

A probe log row: ``probe_id, checked_at, file_type, cycle, status_code, etag,
last_modified, content_length``; the key of a remote file is (file_type,
cycle). The state table kept per probe adds ``changed`` and ``downloaded``.

Ordered logic (previous probe, runs of failures) goes through
``keyed_windows``: the log is dealt out by range of (key, time, id), so a key
with a huge share of it is spread over many tasks instead of landing in one. "Latest row per key" is a ``max(struct)``
aggregate, which has a map-side partial step and needs no sort at all.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotbox.functions.normalize import epoch_micros, source_url
from ballotbox.operators.keyed_windows import dense_ids, previous_in_key, running_count
from ballotbox.session import list_folder, scratch_path

KEYS = ("file_type", "cycle")
ORDER = ("checked_at", "probe_id")
OK_STATUS = 200
STATE_COLUMNS = ("checked_at", "cycle", "file_type", "etag", "last_modified", "changed", "downloaded")


def detect_changes(log: DataFrame, successes_only: bool = False, pieces: int | None = None) -> DataFrame:
    """M3: ``changed`` per probe.

    The first probe of a key is not a change. Otherwise a probe with status
    200 is a change when its etag or last_modified differs from the previous
    probe's, NULL equal to NULL. A failed probe stores NULL tags, so the next
    good probe reads as changed; ``successes_only=True`` compares with the
    previous *successful* probe instead.
    """
    ok = F.col("status_code") == OK_STATUS
    if successes_only:
        good = detect_changes(log.where(ok), pieces=pieces)
        bad = log.where(~ok | F.col("status_code").isNull()).withColumn("changed", F.lit(False))
        return good.unionByName(bad)
    p = previous_in_key(log, KEYS, ORDER, ["etag", "last_modified"], pieces=pieces)
    differs = ~F.col("prev_etag").eqNullSafe(F.col("etag")) | ~F.col("prev_last_modified").eqNullSafe(
        F.col("last_modified"))
    changed = F.coalesce(F.col("has_prev") & ok & differs, F.lit(False))
    return p.select(*log.columns, changed.alias("changed"))


def state_rows(changes: DataFrame, downloaded: Column | None = None) -> DataFrame:
    """M1: the rows the probe step appends to the state table (7 columns)."""
    dl = F.lit(False) if downloaded is None else downloaded
    return changes.select("checked_at", "cycle", "file_type", "etag", "last_modified", "changed",
                          dl.alias("downloaded"))


def append_state(rows: DataFrame, path: str) -> str:
    """M1: append probes to the state table; failures are recorded too."""
    rows.write.mode("append").parquet(path)
    return path


def latest_state(state: DataFrame, tie_break: str | None = "probe_id") -> DataFrame:
    """M2: newest row per key by ``checked_at`` (ties broken by ``tie_break``)."""
    order = ["checked_at"] + ([tie_break] if tie_break and tie_break in state.columns else [])
    payload = [c for c in ("etag", "last_modified", "changed", "downloaded") if c in state.columns]
    agg = state.groupBy(*KEYS).agg(F.max(F.struct(*order, *payload)).alias("r"))
    return agg.select(*KEYS, "r.checked_at", *[f"r.{c}" for c in payload])


def _daily(changes: DataFrame) -> DataFrame:
    """One row per key and day: the day's last probe, and whether any found a change."""
    day = F.to_date("checked_at").alias("observation_date")
    return (changes.groupBy(*KEYS, day)
            .agg(F.max(F.struct("checked_at", "probe_id", "status_code", "etag", "last_modified", "content_length")).alias("r"),
                 F.max("changed").alias("changed"))
            .select(*KEYS, "observation_date", F.col("r.checked_at").alias("probe_time"),
                    F.col("r.status_code").alias("http_status"), "r.etag", "r.last_modified",
                    F.col("r.content_length").cast("bigint").alias("content_length"), "changed"))


OBSERVATION = ("observation_id", "file_type", "cycle", "observation_date", "probe_time", "http_status", "etag",
               "last_modified", "content_length", "changed", "recorded_at")


def daily_observations(changes: DataFrame, base_id: int | Column = 0,
                       recorded_at: Column | None = None) -> DataFrame:
    """M5: one row per key per day (the day's last probe), numbered from ``base_id + 1``.

    ``changed`` is true when any probe of that day found a change. Ids follow
    (day, file_type, cycle); ``base_id`` is the current maximum of the table.
    """
    numbered = dense_ids(_daily(changes), ["observation_date", *KEYS], base_id, "observation_id")
    rec = F.col("probe_time") if recorded_at is None else recorded_at
    return numbered.withColumn("recorded_at", rec).select(*OBSERVATION)


def upsert_observations(spark: SparkSession, probes: DataFrame, path: str) -> DataFrame:
    """M5: new probes (with ``changed``) into the table of daily observations, which is
    stored by day; returns the table.

    Only the days that got probes are read and rewritten. A stored key-day keeps
    its id; its row becomes the later of the stored and the new last probe (the new
    one at equal times), and is changed if either was. New key-days, and only those,
    are numbered, from the greatest id on. Running it again with the same probes
    changes nothing.
    """
    new = _daily(probes)
    start, folders = 0, list_folder(spark, path)
    if any(folder for _, _, folder in folders):
        have = read_observations(spark, path)
        start = have.agg(F.max("observation_id")).first()[0] or 0
        days = new.select(F.col("observation_date").alias("_day")).distinct()
        # the days with new probes, by partition pruning at run time
        old = have.join(F.broadcast(days), have["observation_date"] == days["_day"], "left_semi")
        o, n = old.alias("o"), new.alias("n")
        on = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (*KEYS, "observation_date")]
        newer = F.coalesce(F.col("n.probe_time") >= F.col("o.probe_time"), F.col("o.observation_id").isNull())
        pick = {c: F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
                for c in ("probe_time", "http_status", "etag", "last_modified", "content_length")}
        merged = o.join(n, on, "full_outer").select(
            F.col("o.observation_id").alias("observation_id"),
            *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in (*KEYS, "observation_date")],
            *[v.alias(c) for c, v in pick.items()],
            (F.coalesce("n.changed", F.lit(False)) | F.coalesce("o.changed", F.lit(False))).alias("changed"))
    else:
        merged = new.withColumn("observation_id", F.lit(None).cast("bigint"))
    fresh = dense_ids(merged.where("observation_id IS NULL").drop("observation_id"), ["observation_date", *KEYS], start,
                      "observation_id")
    out = merged.where("observation_id IS NOT NULL").unionByName(fresh).withColumn("recorded_at", F.col("probe_time"))
    held = scratch_path(spark, "observations")          # the days are rewritten from here, not from themselves
    out.select(*OBSERVATION).write.parquet(held)
    (spark.read.schema(out.select(*OBSERVATION).schema).parquet(held).repartition("observation_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("observation_date").parquet(path))
    return read_observations(spark, path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """The stored table of daily observations."""
    schema = ("observation_id long, file_type string, cycle int, observation_date date, probe_time timestamp_ntz, "
              "http_status int, etag string, last_modified string, content_length long, changed boolean, "
              "recorded_at timestamp_ntz")
    return spark.read.schema(schema).parquet(path).select(*OBSERVATION)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per (file_type, cycle) of written raw tables (partial aggregates)."""
    parts = [df.groupBy("cycle").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(ft).alias("file_type"), "cycle", "row_count") for ft, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_history(counts: DataFrame, base_id: int = 0, loaded_at: Column | None = None,
                 raw_root: str = "raw", state: DataFrame | None = None) -> DataFrame:
    """M6: one row per load of (file_type, cycle) with its row count and, from the
    latest ``state`` of the remote file, the tags of what was loaded.

    The numbering window has no partition key; it runs over one row per
    (file type, cycle) pair: nine file types times the loaded cycles.
    """
    w = Window.orderBy("file_type", "cycle")
    at = F.current_timestamp() if loaded_at is None else loaded_at
    cyc = F.col("cycle").cast("string")
    tags = [F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified")]
    if state is not None:
        counts = counts.join(state.select(*KEYS, "etag", "last_modified"), list(KEYS), "left")
        tags = [F.col("etag"), F.col("last_modified")]
    return counts.select(
        (F.lit(base_id) + F.row_number().over(w)).cast("bigint").alias("load_id"),
        "file_type", "cycle",
        source_url("file_type", "cycle").alias("source_url"),
        F.concat(F.lit("data/raw/"), F.col("file_type"), F.lit("_"), cyc, F.lit(".zip")).alias("source_zip_path"),
        F.concat(F.lit(raw_root + "/"), F.col("file_type"), F.lit("/cycle="), cyc).alias("target_parquet_path"),
        F.col("row_count").cast("bigint").alias("row_count"),
        at.alias("loaded_at"), *tags)


def record_load(spark: SparkSession, counts: DataFrame, path: str, loaded_at: Column | None = None,
                raw_root: str = "raw", state: DataFrame | None = None) -> DataFrame:
    """M6: appends a load's rows to the history at ``path``, with the next ids; returns the history."""
    base = 0
    if list_folder(spark, path):
        base = spark.read.parquet(path).agg(F.max("load_id")).first()[0] or 0
    rows = load_history(counts, base, loaded_at, raw_root, state)
    rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stored_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """M7: (file_type, cycle) of what is stored, from the folders alone."""
    found = [(ft, int(name[6:])) for ft, path, folder in list_folder(spark, raw_root) if folder
             for name, _, inner in list_folder(spark, path) if inner and name.startswith("cycle=") and name[6:].isdigit()]
    return spark.createDataFrame(found, "file_type string, cycle int")


def files_to_refresh(changes: DataFrame, stored: DataFrame) -> DataFrame:
    """M7: keys whose latest probe is 200 and that changed or are missing locally."""
    latest = (changes.groupBy(*KEYS)
              .agg(F.max(F.struct("checked_at", "probe_id", "status_code", "changed")).alias("r"))
              .select(*KEYS, "r.checked_at", "r.status_code", "r.changed"))
    have = stored.select(*KEYS).distinct().withColumn("stored", F.lit(True))
    j = latest.join(have, list(KEYS), "left")
    missing = F.col("stored").isNull()
    refresh = (F.col("status_code") == OK_STATUS) & (F.col("changed") | missing)
    return j.where(refresh).select(
        *KEYS, "checked_at", "status_code", "changed", missing.alias("missing_locally"),
        F.when(F.col("changed"), F.lit("changed")).otherwise(F.lit("missing")).alias("reason"))


def target_grid(spans: DataFrame, file_types: Iterable[str]) -> DataFrame:
    """M8: every (style, file_type, cycle) of spans ``(style, start, end)``; steps of 2.

    Built by two ``explode`` generators on each span row, so no join.
    """
    types = F.array(*[F.lit(t) for t in file_types])
    valid = spans.where(F.col("start") <= F.col("end"))
    return (valid.select("style", F.explode(F.sequence("start", "end", F.lit(2))).alias("cycle"))
            .select("style", F.explode(types).alias("file_type"), F.col("cycle").cast("int").alias("cycle")))


def missed_observations(log: DataFrame, grid: DataFrame, start: Column, until: Column) -> DataFrame:
    """M9: days from ``start`` to ``until`` (the run's date) on which a key of the
    ``grid`` has no probe; a collector that has stopped and a key that was never
    probed show up too."""
    days = log.select(*KEYS, F.to_date("checked_at").alias("day")).distinct()
    expected = (grid.select(*KEYS).distinct()
                .select(*KEYS, F.explode(F.sequence(start, until, F.expr("interval 1 day"))).alias("day")))
    missed = expected.join(days, [*KEYS, "day"], "left_anti")
    return missed.select(*KEYS, F.col("day").alias("missed_date"), F.lit("backfill").alias("source"))


def update_frequency(changes: DataFrame) -> DataFrame:
    """Probes, changes and the mean time between changes per key.

    The mean gap telescopes to (last change - first change) / (changes - 1),
    so it is a plain aggregate with no ordering.
    """
    ch = F.col("changed")
    agg = changes.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_probes"),
        F.count_if(F.col("status_code") == OK_STATUS).alias("n_ok"),
        F.count_if(ch).alias("n_changes"),
        F.min(F.when(ch, F.col("checked_at"))).alias("first_change_at"),
        F.max(F.when(ch, F.col("checked_at"))).alias("last_change_at"))
    span_us = epoch_micros("last_change_at") - epoch_micros("first_change_at")
    mean_h = F.when(F.col("n_changes") > 1,
                    span_us / (F.col("n_changes") - 1) / F.lit(3600000000.0))
    return agg.withColumn("mean_hours_between_changes", mean_h)


def outage_spans(log: DataFrame, pieces: int | None = None) -> DataFrame:
    """Runs of consecutive failed probes per key (gaps and islands).

    A failed probe's island is the number of successes before it in key
    order; consecutive failures share it.
    """
    ok = F.col("status_code") == OK_STATUS
    counted = running_count(log, KEYS, ORDER, ok, "successes_before", pieces)
    failed = counted.where(~ok | F.col("status_code").isNull())
    return (failed.groupBy(*KEYS, "successes_before")
            .agg(F.min("checked_at").alias("outage_start"), F.max("checked_at").alias("outage_end"),
                 F.count(F.lit(1)).alias("n_failed_probes"))
            .drop("successes_before"))


def status_label(code: str | Column = "status_code") -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return (F.when(c == 200, F.lit("OK")).when(c == 404, F.lit("not found"))
            .otherwise(F.lit("other")))


def status_summary(log: DataFrame) -> DataFrame:
    """Probes per status label."""
    return (log.groupBy(status_label().alias("status"))
            .agg(F.count(F.lit(1)).alias("n_probes")))


