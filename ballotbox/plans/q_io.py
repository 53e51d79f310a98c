"""Queries for sources and sinks.

Each writes into a fresh folder below ``spark.checkpoint.dir`` and returns
the data read back, so the check covers the writer and the reader together.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.plans import standins, zipwriter
from ballotbox.plans.q_core import staged
from ballotbox.plans.registry import register
from ballotbox.plans.sqlrules import stg_sql
from ballotbox.session import scratch_path
from ballotbox.sources import delimited, jsonsource, load, parquet, sinks, zipsource

RELOAD_CYCLE = 1998
NULLIF_BLANK = "nullif({c}, '')"      # empty fields read as NULL
FAULTY = "right(sub_id, 1) = '7'"     # lines that get a field too many


def _raw_cols(wrap: str) -> str:
    return ", ".join(wrap.format(c=f'"{c}"') + f' as "{c}"' for c in schemas.column_names("indiv"))


@register("scan_delimited", "S1", lambda: (
    f"select {_raw_cols(NULLIF_BLANK)}, cycle from ({standins.raw_sql('indiv')}) r"))
def scan_delimited(spark, sf_dir):
    path = scratch_path(spark, "delimited-indiv")
    delimited.write_raw_text(standins.raw(spark, sf_dir, "indiv"), path, "indiv")
    return delimited.read_raw(spark, path, "indiv")


@register("raw_rejects", "S1", lambda: (
    "select concat_ws('|', " + ", ".join(f"coalesce(\"{c}\", '')" for c in schemas.column_names("indiv")) + ", 'EXTRA') as value,"
    f" cycle, {schemas.width('indiv') + 1} as n_fields from ({standins.raw_sql('indiv')}) r where {FAULTY}"))
def raw_rejects(spark, sf_dir):
    # Every line that the scan leaves out, whole, with its number of fields.
    path = scratch_path(spark, "faulty-indiv")
    raw = standins.raw(spark, sf_dir, "indiv")
    line = delimited.line_of(schemas.column_names("indiv"))
    delimited.write_lines(raw.select(F.when(F.expr(FAULTY), F.concat(line, F.lit("|EXTRA"))).otherwise(line).alias("value"), "cycle"), path)
    return delimited.rejects(delimited.read_lines(spark, path), "indiv")


@register("scan_zip_root_member", "S2", lambda: (
    f"select {_raw_cols(NULLIF_BLANK)}, cycle from ({standins.raw_sql('indiv')}) r"))
def scan_zip_root_member(spark, sf_dir):
    path = scratch_path(spark, "zip-indiv")
    zipwriter.write_zip_archives(standins.raw(spark, sf_dir, "indiv"), path, "indiv").write.format("noop").mode("overwrite").save()
    return zipsource.read_zip(spark, path, "indiv")


@register("zip_to_raw_parquet", "S2", lambda: (
    f"select {_raw_cols(NULLIF_BLANK)}, cycle from ({standins.raw_sql('indiv')}) r"))
def zip_to_raw_parquet(spark, sf_dir):
    # Download-and-load: archives -> raw parquet per cycle -> the raw table.
    base = scratch_path(spark, "zip-load")
    zipwriter.write_zip_archives(standins.raw(spark, sf_dir, "indiv"), f"{base}/zips", "indiv").write.format("noop").mode("overwrite").save()
    load.load_zip_to_raw(spark, f"{base}/zips", "indiv", f"{base}/raw")
    cols = schemas.column_names("indiv") + ["cycle"]
    return parquet.read_raw(spark, f"{base}/raw", "indiv").select(*cols)


@register("partition_overwrite", "S3", lambda: (
    "select " + ", ".join(
        f"case when cycle = {RELOAD_CYCLE} then 'RELOADED' else memo_text end as memo_text" if c == "memo_text"
        else f'"{c}"' for c in schemas.column_names("indiv"))
    + f", cycle from ({standins.raw_sql('indiv')}) r"))
def partition_overwrite(spark, sf_dir):
    root = scratch_path(spark, "raw")
    raw = standins.raw(spark, sf_dir, "indiv")
    parquet.write_raw(raw, root, "indiv")
    # A re-download of one cycle replaces that cycle only.
    reload = raw.where(F.col("cycle") == RELOAD_CYCLE).withColumn("memo_text", F.lit("RELOADED"))
    parquet.write_raw(reload.select(*raw.columns), root, "indiv")
    return parquet.read_raw(spark, root, "indiv").select(*raw.columns)


def _reload_sql() -> str:
    cols = ", ".join(f'"{c}"' for c in schemas.column_names("indiv"))
    base = f"select {cols}, cycle from ({standins.raw_sql('indiv')}) r"
    new = ", ".join("'RELOADED' as memo_text" if c == "memo_text" else f'"{c}"' for c in schemas.column_names("indiv"))
    return (f"with old as ({base}), kept as (select * from old where right(trim(sub_id), 1) not in ('5', '6')),"
            f" again as (select * from kept union all select * from old where right(trim(sub_id), 1) = '7'"
            f" union all select {new}, cycle from old where right(trim(sub_id), 1) = '6'),"
            f" c as (select *, 'added' as change from (select * from again except all select * from old) a"
            f" union all select *, 'vanished' as change from (select * from old except all select * from again) b"
            f" union all select *, 'unchanged' as change from (select * from old intersect all select * from again) d)"
            f" select {cols}, cycle, change, count(*) as n from c group by all")


@register("reload_difference", "S3", _reload_sql)
def reload_difference(spark, sf_dir):
    # Every cycle comes again: some rows gone, some changed, some twice.
    root = scratch_path(spark, "raw")
    raw = standins.raw(spark, sf_dir, "indiv")
    parquet.write_raw(raw, root, "indiv")
    stored = parquet.read_raw(spark, root, "indiv").select(*raw.columns)
    last = F.right(F.trim("sub_id"), F.lit(1))
    again = stored.where(~last.isin("5", "6")).unionAll(stored.where(last == "7")).unionAll(
        stored.where(last == "6").withColumn("memo_text", F.lit("RELOADED")))
    return parquet.changes_between(stored, again)


@register("scan_parquet_cycle", "S4", lambda: f"select * from ({standins.raw_sql('indiv')}) r")
def scan_parquet_cycle(spark, sf_dir):
    root = scratch_path(spark, "raw")
    raw = standins.raw(spark, sf_dir, "indiv")
    parquet.write_raw(raw, root, "indiv")
    views = parquet.register_cycle_views(spark, root, "indiv", parquet.list_cycles(spark, root, "indiv"))
    frames = [spark.table(v).select(*raw.columns) for v in views]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("preview_limit", "S5", lambda: f"select * from ({stg_sql('indiv')}) s order by sub_id limit 10")
def preview_limit(spark, sf_dir):
    return parquet.head(staged(spark, sf_dir, "indiv"), ["sub_id"], 10)


@register("json_source", "S6", lambda: (
    "select event_id, cast(props::json->>'k' as integer) as k from events"))
def json_source(spark, sf_dir):
    ev = standins.table(spark, sf_dir, "events")
    return ev.select("event_id", jsonsource.parse_json("props", "k int").getField("k").alias("k"))


@register("fanout_sinks", "S7", lambda: (
    f"select 'parquet' as sink, * from ({standins.http_records_sql()}) a"
    f" union all select 'json' as sink, * from ({standins.http_records_sql()}) b"))
def fanout_sinks(spark, sf_dir):
    base = scratch_path(spark, "fanout")
    records = standins.http_records(spark, sf_dir)
    pq, js = f"{base}/parquet", f"{base}/json"
    sinks.write_all(records, [sinks.Sink("parquet", pq), sinks.Sink("json", js)])
    from_pq = spark.read.parquet(pq)
    from_js = jsonsource.read_json(spark, js)
    return (from_pq.select(F.lit("parquet").alias("sink"), *records.columns)
            .unionByName(from_js.select(F.lit("json").alias("sink"), *records.columns)))


@register("export_roundtrip", "S8", lambda: stg_sql("cm"))
def export_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "export-cm")
    df = staged(spark, sf_dir, "cm")
    sinks.export(df, path, "csv")
    return sinks.read_export(spark, path, df.schema, "csv")


@register("http_json_append", "S6", lambda: (
    f"select * from ({standins.http_records_sql()}) a union all select * from ({standins.http_records_sql()}) b"))
def http_json_append(spark, sf_dir):
    # Two runs of the fetch step append to the same record table.
    base = scratch_path(spark, "http")
    records = standins.http_records(spark, sf_dir)
    records.write.mode("overwrite").json(f"{base}/fetched")
    table = f"{base}/raw_http_source"
    jsonsource.load_http_source(spark, f"{base}/fetched", table)
    return jsonsource.load_http_source(spark, f"{base}/fetched", table)
