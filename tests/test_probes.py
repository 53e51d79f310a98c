"""Probe log: change detection cases, refresh decisions, keyed windows, grid."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ballotbox.operators import keyed_windows as K
from ballotbox.operators import probes as M

LOG_SCHEMA = ("probe_id long, checked_at timestamp_ntz, file_type string, cycle int, status_code int, "
              "etag string, last_modified string, content_length long")
T0 = dt.datetime(2024, 1, 1, 2, 0)


def log_of(spark, rows):
    out = []
    for i, (ft, cyc, status, etag, lm) in enumerate(rows):
        out.append((i, T0 + dt.timedelta(hours=i), ft, cyc, status, etag, lm, 100))
    return spark.createDataFrame(out, LOG_SCHEMA)


CASES = [
    ("oth", 2018, 200, "v7", "Mon"), ("oth", 2018, 200, "v7", "Mon"),             # nothing new
    ("cn", 2022, 200, "v1", "Tue"), ("cn", 2022, 200, "v2", "Tue"),               # another tag
    ("cm", 2020, 200, "a", "Wed"), ("cm", 2020, 503, None, None), ("cm", 2020, 200, "a", "Wed"),
    ("ccl", 2012, 200, None, None), ("ccl", 2012, 200, None, None),               # no tags at all
]
EXPECTED = [False, False, False, True, False, False, True, False, False]


@pytest.mark.parametrize("pieces", [1, 2, 7])
def test_change_detection_cases(spark, pieces):
    got = M.detect_changes(log_of(spark, CASES), pieces=pieces).orderBy("probe_id").collect()
    assert [r.changed for r in got] == EXPECTED


def test_a_burst_of_one_key_is_split(spark):
    # 20,000 probes of one key inside minutes, one ten years older; many equal times
    burst = spark.range(20_000).selectExpr(
        "id AS probe_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 300) AS checked_at", "'hot' AS file_type",
        "2024 AS cycle", "200 AS status_code", "CAST(id % 5 AS string) AS etag", "'m' AS last_modified", "1L AS content_length")
    old = spark.createDataFrame([(-1, dt.datetime(2014, 1, 1), "hot", 2024, 200, "x", "m", 1)], burst.schema)
    rows = K._walked(burst.union(old), M.KEYS, M.ORDER, 16, ["etag"])
    sizes = [r["count"] for r in rows.groupBy("_piece").count().collect()]
    assert sum(sizes) == 20_001 and max(sizes) <= 2 * 20_001 / 16
    log = burst.union(old)
    assert log.count() == M.detect_changes(log, pieces=16).count()


def test_change_detection_shuffles_the_log_once(spark):
    out = M.detect_changes(_random_log(spark, n=200))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file_type" not in plan and "_ordered" not in plan
    # what is left reads the written, ordered log; the only exchanges are of one row per piece
    assert plan.count("SinglePartition") <= 1


def test_null_keys_are_kept(spark):
    rows = [(0, T0, None, 1, 200, "a", "m", 1), (1, T0 + dt.timedelta(hours=1), None, 1, 200, "b", "m", 1)]
    got = M.detect_changes(spark.createDataFrame(rows, LOG_SCHEMA)).orderBy("probe_id").collect()
    assert [r.changed for r in got] == [False, True]


def test_successes_only_ignores_failed_probe(spark):
    got = M.detect_changes(log_of(spark, CASES), successes_only=True).orderBy("probe_id").collect()
    assert [r.changed for r in got] == [False, False, False, True, False, False, False, False, False]


def test_state_rows_and_latest(spark):
    ch = M.detect_changes(log_of(spark, CASES))
    rows = M.state_rows(ch)
    assert rows.columns == list(M.STATE_COLUMNS) and rows.count() == len(CASES)
    latest = {(r.file_type, r.cycle): r for r in M.latest_state(ch.withColumn("downloaded", F.lit(False))).collect()}
    assert latest[("cn", 2022)].etag == "v2" and latest[("cn", 2022)].changed is True
    assert latest[("cm", 2020)].checked_at == T0 + dt.timedelta(hours=6)


def test_refresh_cases(spark):
    rows = [("a", 2024, 200, "e", "m"), ("a", 2024, 200, "e", "m"),      # stored, unchanged -> no
            ("b", 2024, 200, "e", "m"),                                  # missing -> yes
            ("c", 2024, 200, "e", "m"), ("c", 2024, 200, "f", "m"),      # stored, changed -> yes
            ("d", 2024, 404, None, None)]                                # not 200 -> no
    ch = M.detect_changes(log_of(spark, rows))
    stored = spark.createDataFrame([("a", 2024), ("c", 2024), ("d", 2024)], "file_type string, cycle int")
    got = {r.file_type: r.reason for r in M.files_to_refresh(ch, stored).collect()}
    assert got == {"b": "missing", "c": "changed"}


def _random_log(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c"])
        ts = T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
        status = 200 if rnd.random() < 0.8 else rnd.choice([404, 503])
        etag = None if status != 200 else rnd.choice(["x", "y", None])
        rows.append((i, ts, key, 2024, status, etag, rnd.choice(["m1", "m2"]), 1))
    return spark.createDataFrame(rows, LOG_SCHEMA)


@pytest.mark.parametrize("pieces", [1, 5, 90, None])
def test_previous_in_key_equals_plain_window(spark, pieces):
    log = _random_log(spark)
    split = K.previous_in_key(log, M.KEYS, M.ORDER, ["etag", "checked_at"], pieces=pieces)
    w = Window.partitionBy(*M.KEYS).orderBy(*M.ORDER)
    plain = log.select("probe_id", F.lag("etag").over(w).alias("prev_etag"),
                       F.lag("checked_at").over(w).alias("prev_checked_at"),
                       (F.row_number().over(w) > 1).alias("has_prev"))
    a = sorted(tuple(r) for r in split.select("probe_id", "prev_etag", "prev_checked_at", "has_prev").collect())
    b = sorted(tuple(r) for r in plain.collect())
    assert a == b


@pytest.mark.parametrize("pieces", [1, 3, 60])
def test_running_count_equals_plain_window(spark, pieces):
    log = _random_log(spark, seed=11)
    ok = F.col("status_code") == 200
    split = K.running_count(log, M.KEYS, M.ORDER, ok, "n_ok", pieces)
    w = Window.partitionBy(*M.KEYS).orderBy(*M.ORDER).rowsBetween(Window.unboundedPreceding, 0)
    plain = log.select("probe_id", F.sum(F.when(ok, 1).otherwise(0)).over(w).cast("bigint").alias("n_ok"))
    assert sorted(map(tuple, split.select("probe_id", "n_ok").collect())) == sorted(map(tuple, plain.collect()))


def test_dense_ids_are_consecutive(spark):
    rows = [(dt.date(2024, 1, 1 + i % 5) if i % 9 else None, f"k{i}") for i in range(35)]
    df = spark.createDataFrame(rows, "d date, k string")
    got = K.dense_ids(df, ["d", "k"], base=10, name="id").orderBy("d", "k").collect()
    assert [r.id for r in got] == list(range(11, 46))


def test_daily_observation_one_row_per_key_day(spark):
    log = _random_log(spark, n=500)
    obs = M.daily_observations(M.detect_changes(log))
    assert obs.count() == log.select(*M.KEYS, F.to_date("checked_at")).distinct().count()
    ids = sorted(r.observation_id for r in obs.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_observations_get_the_next_ids(spark, scratch):
    ch = M.detect_changes(_random_log(spark, n=400))
    path = scratch("observations")
    early = ch.where("checked_at < timestamp_ntz'2024-01-08 00:00:00'")
    n = M.upsert_observations(spark, early, path).count()
    both = M.upsert_observations(spark, ch, path)
    rows = sorted(map(tuple, both.collect()))
    again = sorted(map(tuple, M.upsert_observations(spark, ch, path).collect()))
    assert n < len(rows) and rows == again                  # the same probes once more change nothing
    assert len(rows) == ch.select(*M.KEYS, F.to_date("checked_at")).distinct().count()
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1))


def test_a_late_probe_updates_its_day_and_no_other(spark, scratch):
    import glob

    from helpers import local_path

    def probe(i, day, hour, status, changed, cycle=2024):
        return (i, dt.datetime(2024, 1, day, hour), "cm", cycle, status, f"e{i}", None, 10 * i, changed)

    schema = LOG_SCHEMA + ", changed boolean"
    path = scratch("upsert")
    first = [probe(1, 1, 5, 200, False), probe(2, 2, 5, 200, True), probe(3, 3, 5, 200, False)]
    M.upsert_observations(spark, spark.createDataFrame(first, schema), path)
    before = {f for d in (1, 3) for f in glob.glob(f"{local_path(path)}/observation_date=2024-01-0{d}/*.parquet")}
    late = [probe(4, 2, 9, 503, False), probe(5, 2, 3, 404, False), probe(6, 2, 4, 200, False, None)]
    out = {(r.observation_date.day, r.cycle): r for r in M.upsert_observations(spark, spark.createDataFrame(late, schema), path).collect()}
    assert len(out) == 4 and out[2, None].observation_id == 4
    r = out[2, 2024]            # the later probe's row under the old id; the change of the day stays
    assert (r.observation_id, r.probe_time.hour, r.http_status, r.etag, r.content_length, r.changed) == (2, 9, 503, "e4", 40, True)
    after = {f for d in (1, 3) for f in glob.glob(f"{local_path(path)}/observation_date=2024-01-0{d}/*.parquet")}
    assert before == after      # other days were not rewritten
    M.upsert_observations(spark, spark.createDataFrame([probe(7, 2, 1, 200, False)], schema), path)
    assert {r.observation_id: r.etag for r in M.read_observations(spark, path).collect()}[2] == "e4"


def test_loads_are_recorded_with_tags(spark, scratch):
    counts = spark.createDataFrame([("cm", 2024, 7), ("cn", 2022, 3)], "file_type string, cycle int, row_count long")
    state = M.latest_state(M.detect_changes(log_of(spark, CASES)))
    path = scratch("loads")
    M.record_load(spark, counts, path, state=state)
    rows = M.record_load(spark, counts.limit(1), path, state=state).orderBy("load_id").collect()
    assert [(r.load_id, r.file_type, r.row_count, r.etag) for r in rows] == [
        (1, "cm", 7, None), (2, "cn", 3, "v2"), (3, "cm", 7, None)]


def test_stored_files_come_from_folders(spark, scratch):
    from ballotbox.sources import parquet

    root = scratch("stored")
    parquet.write_raw(spark.createDataFrame([(1, 2020), (2, 2022)], "k int, cycle int"), root, "cm")
    assert sorted(map(tuple, M.stored_files(spark, root).collect())) == [("cm", 2020), ("cm", 2022)]


def test_outage_spans(spark):
    rows = [("a", 1, 200, "e", "m"), ("a", 1, 404, None, None), ("a", 1, 503, None, None),
            ("a", 1, 200, "e", "m"), ("a", 1, 404, None, None), ("b", 1, 404, None, None)]
    got = sorted((r.file_type, r.n_failed_probes) for r in M.outage_spans(log_of(spark, rows)).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1)]


def test_missed_observations(spark):
    rows = [(0, dt.datetime(2024, 1, 1), "a", 1, 200, "e", "m", 1), (1, dt.datetime(2024, 1, 4), "a", 1, 200, "e", "m", 1)]
    grid = spark.createDataFrame([("a", 1), ("b", 1)], "file_type string, cycle int")
    got = M.missed_observations(spark.createDataFrame(rows, LOG_SCHEMA), grid, F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 5)))
    days = sorted((r.file_type, r.missed_date.day) for r in got.collect())
    assert days == [("a", 2), ("a", 3), ("a", 5), *(("b", d) for d in range(1, 6))]     # stopped; never probed


def test_update_frequency_mean_gap(spark):
    rows = [("a", 1, 200, "e1", "m"), ("a", 1, 200, "e2", "m"), ("a", 1, 200, "e2", "m"), ("a", 1, 200, "e3", "m")]
    r = M.update_frequency(M.detect_changes(log_of(spark, rows))).first()
    assert r.n_changes == 2 and r.mean_hours_between_changes == pytest.approx(2.0)


def test_status_summary(spark):
    got = {r.status: r.n_probes for r in M.status_summary(log_of(spark, CASES)).collect()}
    assert got == {"OK": 8, "other": 1}


def test_target_grid(spark):
    spans = spark.createDataFrame([("now", 2026, 2026), ("past", 2002, 2008), ("none", 2008, 2002)], "style string, start int, end int")
    grid = M.target_grid(spans, ["cm", "oth", "cn"])
    assert grid.count() == 3 * (1 + 4)
    assert sorted(r.cycle for r in grid.where("style = 'past' AND file_type = 'cn'").collect()) == [2002, 2004, 2006, 2008]


def test_state_table_columns_types_and_append(spark, scratch):
    rows = M.state_rows(M.detect_changes(log_of(spark, CASES)))
    types = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    assert types == [("checked_at", "timestamp_ntz"), ("cycle", "int"), ("file_type", "string"),
                     ("etag", "string"), ("last_modified", "string"), ("changed", "boolean"),
                     ("downloaded", "boolean")]
    path = scratch("state")
    M.append_state(rows, path)
    M.append_state(rows, path)          # every probe run appends; nothing is replaced
    assert spark.read.parquet(path).count() == 2 * len(CASES)


def test_refresh_compares_with_every_file_type(spark, monkeypatch):
    from ballotbox import schemas
    from ballotbox.plans import q_probes

    stored = []
    write = q_probes.parquet.write_raw
    monkeypatch.setattr(q_probes.parquet, "write_raw", lambda df, root, ft, *a: stored.append(ft) or write(df, root, ft, *a))
    q_probes.files_to_refresh(spark, "/root/testdata/sf0.001")
    assert sorted(stored) == sorted(schemas.FILE_TYPES)
    oracle = q_probes.QUERIES["files_to_refresh"].oracle()
    assert all(f"select '{ft}' as file_type" in oracle for ft in schemas.FILE_TYPES)


def test_loads_share_one_pass_over_the_log(spark, monkeypatch):
    from ballotbox.plans import q_probes

    states = []
    record = q_probes.M.record_load
    monkeypatch.setattr(q_probes.M, "record_load", lambda *a, state, **k: states.append(state) or record(*a, state=state, **k))
    q_probes.load_history(spark, "/root/testdata/sf0.001")
    plans = [s._jdf.queryExecution().optimizedPlan().toString() for s in states]
    assert len(plans) == len(q_probes.LOADS) and not any("Aggregate" in p or "Join" in p for p in plans)
