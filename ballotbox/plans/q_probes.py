"""Queries for the probe log (M1-M12), over ``events`` read as a probe log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ballotbox.functions.normalize import BULK_BASE_URL
from ballotbox.operators import probes as M
from ballotbox.plans import standins, zipwriter
from ballotbox.plans.registry import QUERIES, register
from ballotbox.session import scratch_path
from ballotbox.sources import jsonsource, load, parquet
from ballotbox.sources.sinks import Sink
from ballotbox.streaming import fanout, probe_stream, stateful, windowed

LOG = lambda: f"({standins.probe_log_sql()})"
_KEY = "partition by file_type, cycle order by checked_at, probe_id"


def _changes_sql() -> str:
    return (f"select probe_id, checked_at, file_type, cycle, status_code, etag, last_modified, content_length,"
            f" coalesce(row_number() over ({_KEY}) > 1 and status_code = 200"
            f" and (etag is distinct from lag(etag) over ({_KEY})"
            f" or last_modified is distinct from lag(last_modified) over ({_KEY})), false) as changed"
            f" from {LOG()} l")


def changes(spark, sf_dir):
    return M.detect_changes(standins.probe_log(spark, sf_dir))


@register("probe_append", "M1", lambda: (
    f"select checked_at, cycle, file_type, etag, last_modified, changed, false as downloaded"
    f" from ({_changes_sql()}) c"))
def probe_append(spark, sf_dir):
    path = scratch_path(spark, "download-state")
    rows = M.state_rows(changes(spark, sf_dir))
    M.append_state(rows, path)
    return spark.read.parquet(path)


@register("latest_state", "M2", lambda: (
    f"select file_type, cycle, checked_at, etag, last_modified, changed, false as downloaded"
    f" from ({_changes_sql()}) c"
    f" qualify row_number() over (partition by file_type, cycle order by checked_at desc, probe_id desc) = 1"))
def latest_state(spark, sf_dir):
    state = changes(spark, sf_dir).withColumn("downloaded", F.lit(False))
    return M.latest_state(state)


@register("detect_change", "M3", lambda: (
    f"select probe_id, checked_at, file_type, cycle, status_code, etag, last_modified, changed"
    f" from ({_changes_sql()}) c"))
def detect_change(spark, sf_dir):
    return changes(spark, sf_dir).drop("content_length")


@register("detect_change_stream", "M4", lambda: (
    f"select probe_id, checked_at, file_type, cycle, status_code, etag, last_modified, changed, false as late"
    f" from ({_changes_sql()}) c"))
def detect_change_stream(spark, sf_dir):
    log = standins.event_stream(spark, sf_dir)
    base = scratch_path(spark, "probe-stream")
    out = probe_stream.run_available_now(spark, probe_stream.detect_stream(log), f"{base}/out", f"{base}/ckpt")
    return probe_stream.with_wall_clock(out).select(
        "probe_id", "checked_at", "file_type", "cycle", "status_code", "etag", "last_modified", "changed", "late")


@register("detect_change_microbatch", "M4", lambda: (
    f"select probe_id, checked_at, file_type, cycle, status_code, etag, last_modified, changed, false as late"
    f" from ({_changes_sql()}) c"))
def detect_change_microbatch(spark, sf_dir):
    # The same stream answered hour by hour as the watermark closes them, each key's
    # last probe in value state; the run's end closes what is left.
    log = standins.probe_log(spark, sf_dir)
    answered = _closed(spark, log, "probe-hours", dt.timedelta(hours=2),
                       lambda clock: stateful.detect_stream(standins.event_stream(spark, sf_dir), clock))
    late = stateful.late_probes(log, answered).select(*answered.columns[:-1], F.lit(False).alias("changed"))
    return answered.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


def _closed(spark, log, name, after, make):
    """``make(clock)`` run over the stream and closed ``after`` the log's last hour."""
    base = scratch_path(spark, name)
    clock = stateful.Clock(spark, f"{base}/clock")
    last = log.agg(F.max("checked_at")).first()[0]
    until = None if last is None else last.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1, seconds=1) + after
    return stateful.run_closed(spark, lambda: make(clock), clock, until, f"{base}/out", f"{base}/ckpt")


@register("probe_append_stream", "M1", lambda: (
    f"select 'parquet' as sink, * from {LOG()} a union all select 'json' as sink, * from {LOG()} b"))
def probe_append_stream(spark, sf_dir):
    # Probes arriving as a stream, appended to two stores in each micro-batch.
    log = standins.event_stream(spark, sf_dir)
    base = scratch_path(spark, "probe-fanout")
    fanout.append_stream(spark, log, [Sink("parquet", f"{base}/pq"), Sink("json", f"{base}/js")], f"{base}/ckpt")
    cols = list(standins._PROBE_COLS)
    from_pq = spark.read.parquet(f"{base}/pq").select(F.lit("parquet").alias("sink"), *cols)
    js = jsonsource.read_json(spark, f"{base}/js", log.schema.add("batch", "long"))
    return from_pq.unionByName(js.select(F.lit("json").alias("sink"), *cols))


# Probes that come with the second run, days late some of them.
SECOND_RUN = "probe_id % 3 = 0"
_DAY = "partition by file_type, cycle, cast(checked_at as date)"


@register("daily_observation", "M5", lambda: (
    f"with c as (select *, bool_or(not ({SECOND_RUN})) over ({_DAY}) as early,"
    f" bool_or(changed) over ({_DAY}) as any_changed, cast(checked_at as date) as observation_date"
    f" from ({_changes_sql()}) x qualify row_number() over ({_DAY} order by checked_at desc, probe_id desc) = 1)"
    f" select cast(row_number() over (order by early desc, observation_date, file_type, cycle) as bigint) as observation_id,"
    f" file_type, cycle, observation_date, checked_at as probe_time, status_code as http_status,"
    f" etag, last_modified, cast(content_length as bigint) as content_length,"
    f" any_changed as changed, checked_at as recorded_at from c"))
def daily_observation(spark, sf_dir):
    # Two runs: what comes late updates its day, and only new key-days get new ids.
    ch = changes(spark, sf_dir)
    path = scratch_path(spark, "daily-observation")
    M.upsert_observations(spark, ch.where(~F.expr(SECOND_RUN)), path)
    return M.upsert_observations(spark, ch.where(SECOND_RUN), path)


def _counts_sql(file_types) -> str:
    return " union all ".join(
        f"select '{ft}' as file_type, cycle, count(*) as row_count from ({standins.raw_sql(ft)}) r{i} group by cycle"
        for i, ft in enumerate(file_types))


LOADED_AT = ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
LOADS = (("cm", "cn"), ("ccl", "cm", "weball"))      # the second brings one type again


def _load_sql(k: int) -> str:
    return f"select {k} as load, file_type, cycle, row_count, timestamp '{LOADED_AT[k]}' as loaded_at from ({_counts_sql(LOADS[k])}) l{k}"


@register("load_history", "M6", lambda: (
    f"select cast(row_number() over (order by load, file_type, cycle) as bigint) as load_id, file_type, cycle,"
    f" '{BULK_BASE_URL}/' || cast(cycle as varchar) || '/' || file_type"
    f" || right(cast(cycle as varchar), 2) || '.zip' as source_url,"
    f" 'data/raw/' || file_type || '_' || cast(cycle as varchar) || '.zip' as source_zip_path,"
    f" 'raw/' || file_type || '/cycle=' || cast(cycle as varchar) as target_parquet_path,"
    f" row_count, loaded_at, s.etag, s.last_modified from ({_load_sql(0)} union all {_load_sql(1)}) c"
    f" left join (select * from ({_changes_sql()}) x qualify row_number() over"
    f" (partition by file_type, cycle order by checked_at desc, probe_id desc) = 1) s using (file_type, cycle)"))
def load_history(spark, sf_dir):
    # Two loads of archives into one history; each row has the count its load observed.
    base = scratch_path(spark, "load-history")
    state = M.latest_state(changes(spark, sf_dir))
    state.write.parquet(f"{base}/state")        # one row per remote file; the log is gone through once, not in each load
    state = spark.read.schema(state.schema).parquet(f"{base}/state")
    out = None
    for k, file_types in enumerate(LOADS):
        found = None
        for ft in file_types:
            zips = f"{base}/zips{k}/{ft}"
            zipwriter.write_zip_archives(standins.raw(spark, sf_dir, ft), zips, ft).write.format("noop").mode("overwrite").save()
            loaded = load.load_zip_to_raw(spark, zips, ft, f"{base}/raw").select("file_type", "cycle", "row_count")
            found = loaded if found is None else found.unionByName(loaded)
        out = M.record_load(spark, found, f"{base}/history", F.lit(LOADED_AT[k]).cast("timestamp_ntz"), state=state)
    return out


@register("files_to_refresh", "M7", lambda: (
    f"with latest as (select file_type, cycle, checked_at, status_code, changed from ({_changes_sql()}) c"
    f" qualify row_number() over (partition by file_type, cycle order by checked_at desc, probe_id desc) = 1),"
    f" have as (select distinct file_type, cycle from ({_counts_sql(standins.FILE_TYPES)}) s)"
    f" select l.file_type, l.cycle, l.checked_at, l.status_code, l.changed,"
    f" h.file_type is null as missing_locally, case when l.changed then 'changed' else 'missing' end as reason"
    f" from latest l left join have h on l.file_type = h.file_type and l.cycle = h.cycle"
    f" where l.status_code = 200 and (l.changed or h.file_type is null)"))
def files_to_refresh(spark, sf_dir):
    # What is stored is read from the folders of the raw root, not from its tables.
    root = scratch_path(spark, "raw-root")
    for ft in standins.FILE_TYPES:
        parquet.write_raw(standins.raw(spark, sf_dir, ft, by_cycle=True), root, ft)
    return M.files_to_refresh(changes(spark, sf_dir), M.stored_files(spark, root))


@register("target_grid", "M8", lambda: (
    "with c as (select min(cy) as lo, max(cy) as hi from (select cast(year(o_orderdate) + year(o_orderdate) % 2"
    " as int) as cy from orders) o),"
    " spans as (select 'current' as style, hi as s, hi as e from c union all"
    " select 'historical' as style, lo as s, hi - 2 as e from c),"
    " ft as (select unnest([" + ", ".join(f"'{t}'" for t in standins.PROBE_FILE_TYPES) + "]) as file_type)"
    " select style, file_type, cast(unnest(generate_series(s, e, 2)) as int) as cycle"
    " from spans cross join ft where s <= e"))
def target_grid(spark, sf_dir):
    from ballotbox.functions.normalize import cycle_of

    orders = standins.table(spark, sf_dir, "orders")
    c = orders.agg(F.min(cycle_of("o_orderdate")).alias("lo"), F.max(cycle_of("o_orderdate")).alias("hi"))
    spans = c.select(F.explode(F.array(
        F.struct(F.lit("current").alias("style"), F.col("hi").alias("start"), F.col("hi").alias("end")),
        F.struct(F.lit("historical").alias("style"), F.col("lo").alias("start"), (F.col("hi") - 2).alias("end")),
    )).alias("s")).select("s.*")
    return M.target_grid(spans, standins.PROBE_FILE_TYPES)


@register("missed_observations", "M9", lambda: (
    f"with days as (select distinct file_type, cycle, cast(checked_at as date) as d from {LOG()} l),"
    f" b as (select min(cycle) as lo, max(cycle) as hi, min(d) as f, max(d) as t from days),"
    " ft as (select unnest([" + ", ".join(f"'{t}'" for t in standins.PROBE_FILE_TYPES) + "]) as file_type),"
    " cy as (select cast(unnest(generate_series(lo, hi, 2)) as int) as cycle from b),"
    " dd as (select cast(unnest(generate_series(f, t, interval 1 day)) as date) as d from b),"
    " expected as (select file_type, cycle, d from ft cross join cy cross join dd)"
    f" select e.file_type, e.cycle, e.d as missed_date, 'backfill' as source from expected e"
    f" where not exists (select 1 from days x where x.file_type = e.file_type and x.cycle = e.cycle"
    f" and x.d = e.d)"))
def missed_observations(spark, sf_dir):
    # The configured grid up to the log's last day, so a collector that stopped
    # early and keys that were never probed are reported.
    log = standins.probe_log(spark, sf_dir)
    day = F.to_date("checked_at")
    lo, hi, first, last = log.agg(F.min("cycle"), F.max("cycle"), F.min(day), F.max(day)).first()
    spans = spark.createDataFrame([("all", lo, hi)], "style string, start int, end int")
    grid = M.target_grid(spans, standins.PROBE_FILE_TYPES)
    return M.missed_observations(log, grid, F.lit(first).cast("date"), F.lit(last).cast("date"))


@register("missed_observations_stream", "M9", lambda: QUERIES["missed_observations"].oracle())
def missed_observations_stream(spark, sf_dir):
    # The same days, reported by timers as the watermark passes them: no row of the key is needed.
    log = standins.probe_log(spark, sf_dir)
    day = F.to_date("checked_at")
    lo, hi, first, last = log.agg(F.min("cycle"), F.max("cycle"), F.min(day), F.max(day)).first()
    grid = M.target_grid(spark.createDataFrame([("all", lo, hi)], "style string, start int, end int"), standins.PROBE_FILE_TYPES)
    base = scratch_path(spark, "missed-days")
    clock = stateful.Clock(spark, f"{base}/clock")
    until = None if last is None else dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1, hours=1, seconds=1)
    return stateful.run_closed(
        spark, lambda: stateful.missed_stream(standins.event_stream(spark, sf_dir), clock, grid, first or dt.date(1970, 1, 1)),
        clock, until, f"{base}/out", f"{base}/ckpt")


@register("update_frequency", "M10", lambda: (
    f"select file_type, cycle, count(*) as n_probes, count(*) filter (where status_code = 200) as n_ok,"
    f" count(*) filter (where changed) as n_changes,"
    f" min(checked_at) filter (where changed) as first_change_at,"
    f" max(checked_at) filter (where changed) as last_change_at,"
    f" case when count(*) filter (where changed) > 1 then"
    f" (epoch_us(max(checked_at) filter (where changed)) - epoch_us(min(checked_at) filter (where changed)))"
    f" / (count(*) filter (where changed) - 1) / 3600000000.0 end as mean_hours_between_changes"
    f" from ({_changes_sql()}) c group by file_type, cycle"))
def update_frequency(spark, sf_dir):
    return M.update_frequency(changes(spark, sf_dir))


@register("outage_spans", "M11", lambda: (
    f"with c as (select *, sum(case when status_code = 200 then 1 else 0 end) over ({_KEY}"
    f" rows between unbounded preceding and current row) as island from {LOG()} l)"
    f" select file_type, cycle, min(checked_at) as outage_start, max(checked_at) as outage_end,"
    f" count(*) as n_failed_probes from c where status_code <> 200 or status_code is null"
    f" group by file_type, cycle, island"))
def outage_spans(spark, sf_dir):
    return M.outage_spans(standins.probe_log(spark, sf_dir))


OUTAGE_GAP_HOURS = 12


@register("outage_sessions_stream", "M11", lambda: (
    f"with f as (select file_type, cycle, checked_at, coalesce(epoch_us(checked_at)"
    f" - epoch_us(lag(checked_at) over (partition by file_type, cycle order by checked_at)) > {OUTAGE_GAP_HOURS} * 3600000000, true)"
    f" as opens from {LOG()} l where status_code <> 200 or status_code is null),"
    f" i as (select *, sum(case when opens then 1 else 0 end) over (partition by file_type, cycle order by checked_at"
    f" range between unbounded preceding and current row) as island from f)"
    f" select file_type, cycle, min(checked_at) as outage_start, max(checked_at) as outage_end, count(*) as n_failed_probes"
    f" from i group by file_type, cycle, island"))
def outage_sessions_stream(spark, sf_dir):
    # Failed probes at most twelve hours apart are one outage (session windows).
    return _closed(spark, standins.probe_log(spark, sf_dir), "outages", dt.timedelta(hours=OUTAGE_GAP_HOURS + 2),
                   lambda clock: stateful.outage_stream(standins.event_stream(spark, sf_dir), clock, f"{OUTAGE_GAP_HOURS} hours"))


@register("status_daily_stream", "M12", lambda: (
    f"select cast(checked_at as date) as day, case when status_code = 200 then 'OK'"
    f" when status_code = 404 then 'not found' else 'other' end as status, count(*) as n_probes"
    f" from {LOG()} l group by 1, 2"))
def status_daily_stream(spark, sf_dir):
    # Probe counts per day and status from the stream, whatever its order.
    log = standins.event_stream(spark, sf_dir)
    base = scratch_path(spark, "status-daily")
    return windowed.run_available_now(spark, log, f"{base}/out", f"{base}/ckpt")


@register("status_summary", "M12", lambda: (
    f"select case when status_code = 200 then 'OK' when status_code = 404 then 'not found' else 'other' end"
    f" as status, count(*) as n_probes from {LOG()} l group by 1"))
def status_summary(spark, sf_dir):
    return M.status_summary(standins.probe_log(spark, sf_dir))
