"""The streaming change detector agrees with batch detection."""

import datetime as dt

from pyspark.sql import functions as F

from ballotbox.operators import probes as M
from ballotbox.streaming import probe_stream

from helpers import local_path
from test_probes import LOG_SCHEMA, _random_log


def _append_in_order(frames, folder):
    """Append each frame as its own files with increasing mtimes (the file
    source feeds files to micro-batches in modification-time order)."""
    import glob
    import os
    import time

    path = local_path(folder)
    seen = set()
    stamp = time.time() - 10_000
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(folder)
        new = [f for f in glob.glob(os.path.join(path, "*.parquet")) if f not in seen]
        stamp += 10
        for f in new:
            os.utime(f, (stamp, stamp))
        seen.update(new)


def _stream(spark, folder, ckpt, out):
    src = (spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder))
    res = probe_stream.run_available_now(spark, probe_stream.detect_stream(src), out, ckpt)
    return probe_stream.with_wall_clock(res)


def test_stream_in_time_order_equals_batch(spark, scratch):
    log = _random_log(spark, n=1500, seed=3)
    folder = scratch("stream-in")
    days = sorted(r.d for r in log.select(F.to_date("checked_at").alias("d")).distinct().collect())
    # one file per day, in time order -> one micro-batch each
    _append_in_order([log.where(F.to_date("checked_at") == F.lit(d)) for d in days], folder)
    base = scratch("stream")
    got = _stream(spark, folder, f"{base}/ckpt", f"{base}/out")
    batch = M.detect_changes(log).select("probe_id", "changed")
    assert got.where("late").count() == 0
    assert sorted(map(tuple, got.select("probe_id", "changed").collect())) == sorted(map(tuple, batch.collect()))


def test_late_probe_is_flagged_and_not_latest(spark, scratch):
    folder = local_path(scratch("late-in"))
    t = dt.datetime(2024, 1, 1)
    first = [(1, t + dt.timedelta(hours=5), "a", 1, 200, "e1", "m", 1), (2, t + dt.timedelta(hours=6), "a", 1, 200, "e1", "m", 1)]
    late = [(3, t + dt.timedelta(hours=1), "a", 1, 200, "zz", "m", 1), (4, t + dt.timedelta(hours=7), "a", 1, 200, "e1", "m", 1)]
    _append_in_order([spark.createDataFrame(first, LOG_SCHEMA), spark.createDataFrame(late, LOG_SCHEMA)], folder)
    base = scratch("late")
    got = {r.probe_id: (r.changed, r.late) for r in _stream(spark, folder, f"{base}/c", f"{base}/o").collect()}
    assert got == {1: (False, False), 2: (False, False), 3: (False, True), 4: (False, False)}


def test_fanout_batch_replay_is_idempotent(spark, scratch):
    from ballotbox.sources.sinks import Sink
    from ballotbox.streaming import fanout

    base = scratch("fan-replay")
    sinks = [Sink("parquet", f"{base}/p"), Sink("json", f"{base}/j")]
    write = fanout._batch_writer(sinks)
    batch0 = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0, 123456))], "k int, t timestamp_ntz")
    batch1 = spark.createDataFrame([(2, dt.datetime(2024, 1, 2))], "k int, t timestamp_ntz")
    write(batch0, 0)
    write(batch1, 1)
    write(batch0, 0)        # replay of batch 0 after a failure
    assert sorted(r.k for r in spark.read.parquet(f"{base}/p").collect()) == [1, 2]
    js = spark.read.schema("k int, t timestamp_ntz, batch long").options(
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{base}/j")
    assert sorted((r.k, r.t.microsecond) for r in js.collect()) == [(1, 123456), (2, 0)]


def _write_days(log, folder):
    days = sorted(r.d for r in log.select(F.to_date("checked_at").alias("d")).distinct().collect())
    _append_in_order([log.where(F.to_date("checked_at") == F.lit(d)) for d in days], folder)


def _closing(spark, scratch, name, folder, make, until):
    """Runs ``make(probes, clock)`` over the folder's files so far; again for what came since."""
    from ballotbox.streaming import stateful

    base = scratch(name)
    clock = stateful.Clock(spark, f"{base}/clock")

    def stream():
        return make(spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder), clock)

    def go(close):
        return stateful.run_closed(spark, stream, clock, until if close else None, f"{base}/out", f"{base}/ckpt")
    return go


def test_stateful_detector_equals_batch_and_restarts(spark, scratch):
    from ballotbox.streaming import stateful

    log = _random_log(spark, n=1200, seed=9)
    last = log.agg(F.max("checked_at")).first()[0]
    days = sorted(r.d for r in log.select(F.to_date("checked_at").alias("d")).distinct().collect())
    folder = scratch("st-in")
    half = len(days) // 2
    frames = [log.where(F.to_date("checked_at") == F.lit(d)) for d in days]
    _append_in_order(frames[:half], folder)
    go = _closing(spark, scratch, "st", folder, stateful.detect_stream, last + dt.timedelta(hours=5))
    want = {r.probe_id: r.changed for r in M.detect_changes(log).collect()}
    first = {r.probe_id: r.changed for r in go(False).collect()}
    assert first and first.items() <= want.items() and len(first) < len(want)
    _append_in_order(frames[half:], folder)         # later files, a new query on the old checkpoint
    got = [(r.probe_id, r.changed) for r in go(True).collect()]
    assert sorted(got) == sorted(want.items())
    assert stateful.late_probes(log, go(False)).count() == 0


def test_probes_out_of_order_within_the_delay_are_answered_and_later_ones_are_late(spark, scratch):
    from ballotbox.streaming import stateful

    t = dt.datetime(2024, 1, 1)
    rows = [[(2, t + dt.timedelta(minutes=150), "a", 1, 200, "e2", "m", 1), (1, t + dt.timedelta(minutes=10), "a", 1, 200, "e1", "m", 1),
             (10, t + dt.timedelta(minutes=20), None, None, 200, "x", None, 1)],
            [(3, t + dt.timedelta(minutes=100), "a", 1, 200, "e2", "m", 1), (11, t + dt.timedelta(minutes=170), None, None, 200, "y", None, 1),
             (12, t + dt.timedelta(minutes=171), None, None, 500, None, None, 1)],
            [(4, t + dt.timedelta(hours=9), "a", 1, 200, "e2", "m", 1)],
            [(5, t + dt.timedelta(hours=1), "a", 1, 200, "zz", "m", 1), (6, t + dt.timedelta(hours=9), "a", 1, 200, "e3", "n", 1)]]
    folder = scratch("late-hours")
    frames = [spark.createDataFrame(r, LOG_SCHEMA) for r in rows]
    base_delay = "2 hours"
    go = _closing(spark, scratch, "lh", folder, lambda p, c: stateful.detect_stream(p, c, base_delay), t + dt.timedelta(days=1))
    for f in frames:
        _append_in_order([f], folder)
        go(False)
    out = go(True)
    got = {r.probe_id: r.changed for r in out.collect()}
    # 3 came after 2 but lies before it: the answers are those of the log in time order
    assert got == {1: False, 3: True, 2: False, 4: False, 6: True, 10: False, 11: True, 12: False}
    log = spark.createDataFrame(sum(rows, []), LOG_SCHEMA)
    assert [r.probe_id for r in stateful.late_probes(log, out).collect()] == [5]


def test_a_stopped_collector_is_reported_by_a_timer(spark, scratch):
    from ballotbox.streaming import stateful

    t = dt.datetime(2024, 1, 1, 3)
    day = dt.timedelta(days=1)
    # "a" is probed daily and goes on; "b" stops after the first day; "c" never was; "z" is not in the grid
    rows = [[(i * 10, t + i * day, "a", 2024, 200, "e", "m", 1)] + ([(5, t, "b", 2024, 200, "e", "m", 1)] if i == 0 else [])
            + ([(7, t + i * day, "z", 2024, 200, "e", "m", 1)] if i == 1 else []) for i in range(5)]
    folder = scratch("stopped-in")
    grid = spark.createDataFrame([("a", 2024), ("b", 2024), ("c", 2024)], "file_type string, cycle int")
    go = _closing(spark, scratch, "stopped", folder,
                  lambda p, c: stateful.missed_stream(p, c, grid, dt.date(2024, 1, 1)), dt.datetime(2024, 1, 8, 2))
    for r in rows[:3]:
        _append_in_order([spark.createDataFrame(r, LOG_SCHEMA)], folder)
    found = {(r.file_type, r.missed_date.day) for r in go(False).collect()}
    assert found == {("b", 2), ("c", 1), ("c", 2)}          # only "a" had rows since
    _append_in_order([spark.createDataFrame(r, LOG_SCHEMA) for r in rows[3:]], folder)
    found = sorted((r.file_type, r.missed_date.day) for r in go(True).collect())
    log = spark.createDataFrame(sum(rows, []), LOG_SCHEMA)
    want = M.missed_observations(log, grid, F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 7)))
    assert found == sorted((r.file_type, r.missed_date.day) for r in want.collect()) and len(found) == 2 + 6 + 7


def test_outage_sessions_equal_islands_and_late_failures_are_counted(spark, scratch):
    from ballotbox.streaming import stateful

    t, hour = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    # probes every hour: a gap of an hour and a half ends an outage at the first success
    states = {"a": "xx..xxx.x", "b": ".........", None: "x.xxxxx.."}
    rows = [(100 * k + i, t + i * hour, key, 1 if key else None, 503 if c == "x" else 200, None, None, 1)
            for k, (key, line) in enumerate(states.items()) for i, c in enumerate(line)]
    late = (999, t + hour / 2, "b", 1, 500, None, None, 1)
    folder = scratch("out-in")
    go = _closing(spark, scratch, "out", folder, lambda p, c: stateful.outage_stream(p, c, "90 minutes", "1 minute"), t + 48 * hour)
    for i in range(0, 9, 3):
        _append_in_order([spark.createDataFrame([r for r in rows if i <= (r[1] - t) / hour < i + 3], LOG_SCHEMA)], folder)
        go(False)
    _append_in_order([spark.createDataFrame([late], LOG_SCHEMA)], folder)
    out = go(True)
    log = spark.createDataFrame([*rows, late], LOG_SCHEMA)
    want = M.outage_spans(spark.createDataFrame(rows, LOG_SCHEMA))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.select(*out.columns).collect()))
    assert [r.probe_id for r in stateful.late_failures(log, out).collect()] == [999]
    failed = sum(r[4] != 200 for r in [*rows, late])
    assert failed - out.agg(F.sum("n_failed_probes")).first()[0] == 1


def test_windowed_counts_equal_batch(spark, scratch):
    from ballotbox.streaming import windowed

    log = _random_log(spark, n=800, seed=13)
    folder = scratch("win-in")
    _write_days(log, folder)
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 3).parquet(folder)
    base = scratch("win")
    got = windowed.run_available_now(spark, src, f"{base}/out", f"{base}/ckpt")
    want = log.groupBy(F.to_date("checked_at").alias("day"), M.status_label().alias("status")).count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_windowed_counts_include_every_late_probe(spark, scratch):
    # Days and years late: each one counts.
    from ballotbox.streaming import windowed

    folder = scratch("wm-in")
    t = dt.datetime(2024, 1, 10)
    batches = [[(1, t, "a", 1, 200, "e", "m", 1)],
               [(2, t + dt.timedelta(days=5), "a", 1, 200, "e", "m", 1)],
               [(3, t + dt.timedelta(hours=1), "a", 1, 200, "e", "m", 1),        # 5 days late
                (4, t + dt.timedelta(days=5, hours=1), "a", 1, 404, None, None, 1),
                (5, t - dt.timedelta(days=900), "a", 1, 200, "e", "m", 1)]]
    _append_in_order([spark.createDataFrame(rows, LOG_SCHEMA) for rows in batches], folder)
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    base = scratch("wm")
    got = {(r.day, r.status): r.n_probes for r in
           windowed.run_available_now(spark, src, f"{base}/out", f"{base}/ckpt").collect()}
    assert got == {(dt.date(2024, 1, 10), "OK"): 2, (dt.date(2024, 1, 15), "OK"): 1,
                   (dt.date(2024, 1, 15), "not found"): 1, (t.date() - dt.timedelta(days=900), "OK"): 1}
    assert windowed.compact(spark, f"{base}/out", f"{base}/all").count() == 4


def test_stream_queries_read_a_folder_of_files(spark, scratch):
    import os
    import shutil

    import __spark_entry__ as entry

    # the same table as one file and as a folder of files, out of time order
    source = "/root/testdata/sf0.001"
    many = local_path(scratch("tables"))
    os.makedirs(many)
    for name in os.listdir(source):
        if name != "events.parquet":
            shutil.copy(f"{source}/{name}", f"{many}/{name}")
    events = spark.read.parquet(f"{source}/events.parquet")
    events.repartition(3, "event_id").write.parquet(f"{many}/events.parquet")
    for name in ("status_daily_stream", "probe_append_stream"):
        query = entry.queries()[name]
        assert sorted(map(str, query(spark, many).collect())) == sorted(map(str, query(spark, source).collect()))
    for name in ("detect_change_stream", "detect_change_microbatch"):
        assert entry.queries()[name](spark, many).count() == events.count()
