"""Delimited scan with quoting off, ZIP member choice, parquet overwrite, CSV export."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ballotbox import schemas
from ballotbox.plans import zipwriter
from ballotbox.sources import delimited, jsonsource, load, parquet, sinks, zipsource
from helpers import local_path


def test_quote_is_not_special(spark, scratch):
    path = local_path(scratch("quote"))
    os.makedirs(path)
    with open(os.path.join(path, "ccl.txt"), "w") as fh:
        fh.write('C1|N|"ACME|x||"|\n')
    df = delimited.read_raw(spark, path, "ccl")
    r = df.first()
    assert (r.cand_id, r.cand_election_yr, r.fec_election_yr, r.cmte_id) == ("C1", "N", '"ACME', "x")
    assert r.cmte_tp is None


def test_lines_of_another_width_are_rejected_whole(spark, scratch):
    path = local_path(scratch("width"))
    os.makedirs(path)
    lines = ["a|b|c|d|e|f|g", "too|short", "a|b|c|d|e|f|g|long", "", "Łódź|x\ry|c|d|e|f|é\r"]
    with open(os.path.join(path, "ccl.txt"), "wb") as fh:
        fh.write("\n".join(lines).encode())
    good = delimited.read_raw(spark, path, "ccl").collect()
    assert sorted(r[0] for r in good) == ["a", "Łódź"]
    city = next(r for r in good if r[0] != "a")
    assert (city[1], city[6]) == ("x\ry", "é")          # a lone carriage return is text
    bad = delimited.rejects(delimited.read_lines(spark, path), "ccl").collect()
    assert sorted((r.value, r.n_fields) for r in bad) == [("", 1), ("a|b|c|d|e|f|g|long", 8), ("too|short", 2)]


def test_zip_lines_and_load(spark, scratch):
    root, raw = local_path(scratch("load")), scratch("load-raw")
    os.makedirs(root)
    _zip(os.path.join(root, "ccl24.zip"), {"ccl.txt": "Łódź|x\ry|c|d|e|f|g\nshort|line\n"})
    rows = load.load_zip_to_raw(spark, root, "ccl", raw).collect()
    assert [tuple(r) for r in rows] == [("ccl", 2024, 1, 1)]
    r = parquet.read_raw(spark, raw, "ccl").first()
    assert (r[0], r[1], r.cycle) == ("Łódź", "x\ry", 2024)
    assert spark.read.parquet(f"{raw}/_rejects/ccl").first().value == "short|line"
    # a second load reports its own cycle only
    other = local_path(scratch("load"))
    os.makedirs(other)
    _zip(os.path.join(other, "ccl_2022.zip"), {"ccl.txt": "a|b|c|d|e|f|g\n"})
    assert [tuple(r) for r in load.load_zip_to_raw(spark, other, "ccl", raw).collect()] == [("ccl", 2022, 1, 0)]
    assert parquet.list_cycles(spark, raw, "ccl") == [2022, 2024]


def test_archives_that_cannot_be_read_are_named(spark, scratch):
    root = local_path(scratch("bad"))
    os.makedirs(root)
    _zip(os.path.join(root, "indiv_2020.zip"), {"indiv20/itcont.txt": "x\n"})
    with pytest.raises(Exception, match="indiv_2020.zip"):
        zipsource.read_zip(spark, root, "indiv").collect()
    _zip(os.path.join(root, "indiv_2018.zip"), {"ITCONT.TXT": "|".join("x" * schemas.width("indiv")) + "\n"})
    assert zipsource.read_zip(spark, os.path.join(root, "indiv_2018.zip"), "indiv").count() == 1
    _zip(os.path.join(root, "indiv.zip"), {"itcont.txt": "x\n"})
    with pytest.raises(ValueError, match="indiv.zip"):
        zipsource.read_zip(spark, root, "indiv")
    with pytest.raises(FileNotFoundError):
        zipsource.read_zip(spark, scratch("empty"), "indiv")


def test_rows_without_a_cycle_are_kept(spark, scratch):
    root = scratch("no-cycle")
    df = spark.createDataFrame([("a", 2020), ("b", None)], "k string, cycle int")
    parquet.write_raw(df, root, "t")
    assert parquet.list_cycles(spark, root, "t") == [2020, None]
    assert sorted(r.k for r in parquet.read_raw(spark, root, "t", [2020, None]).collect()) == ["a", "b"]
    assert [r.k for r in parquet.read_raw(spark, root, "t", [None]).collect()] == ["b"]


def test_malformed_json_is_kept_apart(spark, scratch):
    path = local_path(scratch("json"))
    os.makedirs(path)
    with open(os.path.join(path, "x.json"), "w") as fh:
        fh.write('{"url": "u", "status_code": 200, "content": "c"}\n{"url": \n\n{"url": "v"}\n')
    assert sorted(r.url for r in jsonsource.read_json(spark, path).collect()) == ["u", "v"]
    assert [r.value for r in jsonsource.json_rejects(spark, path).collect()] == ['{"url": ']


def test_row_width_check(spark):
    from ballotbox.operators.quality import row_width

    lines = spark.createDataFrame([("a|b|c",), ("a|b",), ("a|b|c|",)], "value string")
    r = row_width(lines, 3).first()
    assert (r.n_lines, r.n_bad_width, r.min_width, r.max_width) == (3, 2, 2, 4)


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_zip_reads_root_member_only(spark, scratch):
    root = local_path(scratch("zips"))
    os.makedirs(root)
    w = schemas.width("indiv")
    row1 = "|".join(["C1"] + ["x"] * (w - 1))
    row2 = "|".join(["C2"] + ["y"] * (w - 1))
    _zip(os.path.join(root, "indiv_2024.zip"),
         {"itcont.txt": row1 + "\n" + row2 + "\n", "by_date/itcont_2024_0101.txt": row1 + "\n"})
    df = zipsource.read_zip(spark, root, "indiv")
    rows = sorted((r.cmte_id, r.cycle) for r in df.collect())
    assert rows == [("C1", 2024), ("C2", 2024)]


def test_zip_other_types_read_root_txt(spark, scratch):
    root = local_path(scratch("zips"))
    os.makedirs(root)
    _zip(os.path.join(root, "cm_2022.zip"), {"cm.txt": "|".join(["C9"] + [""] * 14) + "\r\n",
                                             "sub/extra.txt": "ignored\n"})
    df = zipsource.read_zip(spark, root, "cm")
    r = df.collect()
    assert len(r) == 1 and r[0].cmte_id == "C9" and r[0].cand_id is None and r[0].cycle == 2022


def test_zip_writer_roundtrip(spark, scratch):
    path = scratch("zipw")
    raw = spark.createDataFrame([tuple(f"v{i}_{j}" for j in range(21)) + (2000 + 2 * (i % 2),) for i in range(50)],
                                schemas.raw_schema("indiv").add("cycle", IntegerType())).repartition(3)
    summary = zipwriter.write_zip_archives(raw, path, "indiv").collect()
    assert sum(r.n_lines for r in summary) == 50
    back = zipsource.read_zip(spark, path, "indiv")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))


def test_dynamic_partition_overwrite_keeps_other_cycles(spark, scratch):
    root = scratch("raw")
    df = spark.createDataFrame([(i, "a", 1996 + 2 * (i % 4)) for i in range(40)], "k int, v string, cycle int")
    parquet.write_raw(df, root, "t")
    parquet.write_raw(df.where("cycle = 1998").withColumn("v", F.lit("b")), root, "t")
    back = parquet.read_raw(spark, root, "t")
    assert parquet.list_cycles(spark, root, "t") == [1996, 1998, 2000, 2002]
    assert parquet.list_cycles(spark, root, "missing") == []
    got = {(r.cycle, r.v) for r in back.collect()}
    assert got == {(1996, "a"), (1998, "b"), (2000, "a"), (2002, "a")}
    assert back.count() == 40
    pruned = parquet.read_raw(spark, root, "t", [2000])
    assert "PartitionFilters: [isnotnull(cycle" in pruned._jdf.queryExecution().executedPlan().toString() \
        or pruned.count() == 10


def test_csv_export_keeps_blank_and_null(spark, scratch):
    path = scratch("export")
    df = spark.createDataFrame([(1, "", None, " pad \t"), (2, 'q"u|o,te', "x", "multi\nline")],
                               "k int, a string, b string, c string")
    sinks.export(df, path)
    back = sinks.read_export(spark, path, df.schema).orderBy("k").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.orderBy("k").collect()]


def test_fanout_writes_every_sink(spark, scratch):
    base = scratch("fan")
    df = spark.range(5).withColumn("s", F.col("id").cast("string"))
    sinks.write_all(df, [sinks.Sink("parquet", f"{base}/p"), sinks.Sink("json", f"{base}/j")])
    assert spark.read.parquet(f"{base}/p").count() == 5
    assert spark.read.json(f"{base}/j").count() == 5


def test_zip_writer_rerun_replaces_archives(spark, scratch):
    path = scratch("zip-rerun")
    raw = spark.createDataFrame([tuple(f"v{i}_{j}" for j in range(21)) + (2000 + 2 * (i % 2),) for i in range(30)],
                                schemas.raw_schema("indiv").add("cycle", IntegerType())).repartition(2)
    first = zipwriter.write_zip_archives(raw, path, "indiv").collect()
    again = zipwriter.write_zip_archives(raw, path, "indiv").collect()   # a rerun of the same job
    assert sorted(r.archive for r in first) == sorted(r.archive for r in again)
    assert zipsource.read_zip(spark, path, "indiv").count() == 30


def test_latin1_lines_are_decoded(spark, scratch):
    path = local_path(scratch("latin1"))
    os.makedirs(path)
    with open(os.path.join(path, "ccl.txt"), "wb") as fh:
        fh.write("café|\xa0x|c|d|e|f|Ærø\r\n|b|c|d|e|f|g\n".encode("latin-1"))
    rows = delimited.read_raw(spark, path, "ccl", encoding="ISO-8859-1").collect()
    assert [(r[0], r[1], r[6]) for r in rows] == [("café", "\xa0x", "Ærø"), (None, "b", "g")]
    with pytest.raises(ValueError, match="UTF-16"):
        delimited.read_lines(spark, path, "UTF-16")


def test_latin1_archives(spark, scratch):
    root, raw = local_path(scratch("latin1-zip")), scratch("latin1-raw")
    os.makedirs(root)
    with zipfile.ZipFile(os.path.join(root, "ccl_2024.zip"), "w") as z:
        z.writestr("ccl.txt", "café|b|c|d|e|f|g\n".encode("latin-1"))
    assert load.load_zip_to_raw(spark, root, "ccl", raw, encoding="ISO-8859-1").first().row_count == 1
    assert parquet.read_raw(spark, raw, "ccl").first()[0] == "café"
    with pytest.raises(Exception, match="ccl_2024.zip is not UTF-8"):
        zipsource.read_zip(spark, root, "ccl").collect()
    with pytest.raises(Exception, match="UTF-16"):
        zipsource.read_zip(spark, root, "ccl", encoding="UTF-16").collect()


def test_the_source_reads_only_the_members_asked_for(spark, scratch):
    root = local_path(scratch("members"))
    os.makedirs(os.path.join(root, "deep"))
    row = "a|b|c|d|e|f|g\n"
    _zip(os.path.join(root, "ccl_2024.zip"), {"one.txt": row * 3, "two.txt": row})
    _zip(os.path.join(root, "deep", "ccl_2022.zip"), {"one.txt": row * 2})
    lines = zipsource.read_zip_lines(spark, root, "ccl")
    assert lines.rdd.getNumPartitions() == 3 and lines.count() == 6
    assert zipsource.read_zip_lines(spark, root, "ccl", cycles=[2024], members=["one.txt", "none.txt"]).count() == 3
    # frames and their filtered forms do not disturb each other
    assert lines.where("cycle = 2024").union(lines.where("cycle = 2022")).union(lines).count() == 12
    # damage in a member that is not asked for stays unseen
    with open(os.path.join(root, "deep", "ccl_2022.zip"), "r+b") as fh:
        fh.seek(40)
        fh.write(b"\xff\xff\xff")
    assert zipsource.read_zip_lines(spark, root, "ccl", cycles=[2024]).count() == 4
    with pytest.raises(Exception):
        lines.count()
    assert spark.read.format("bulkzip").option("file_type", "ccl").load(os.path.join(root, "ccl_2024.zip")).count() == 4
    assert zipsource.read_zip_lines(spark, root, "ccl", members=["none.txt"]).count() == 0


def test_a_reload_replaces_rows_and_rejects_and_inflates_once(spark, scratch, monkeypatch):
    root, raw = local_path(scratch("again")), scratch("again-raw")
    os.makedirs(root)
    path = os.path.join(root, "ccl_2024.zip")
    _zip(path, {"ccl.txt": "a|b|c|d|e|f|g\nshort\n"})
    assert [tuple(r) for r in load.load_zip_to_raw(spark, root, "ccl", raw).collect()] == [("ccl", 2024, 1, 1)]
    _zip(path, {"ccl.txt": "x|b|c|d|e|f|g\ny|b|c|d|e|f|g\n"})
    calls = []
    real = zipsource.read_zip_lines
    monkeypatch.setattr(zipsource, "read_zip_lines", lambda *a, **k: calls.append(a) or real(*a, **k))
    out = load.load_zip_to_raw(spark, root, "ccl", raw)
    os.remove(path)                                     # nothing is read from the archive after the load
    assert [tuple(r) for r in out.collect()] == [("ccl", 2024, 2, 0)] and len(calls) == 1
    assert sorted(r[0] for r in parquet.read_raw(spark, raw, "ccl").collect()) == ["x", "y"]
    assert parquet.list_cycles(spark, f"{raw}/_rejects", "ccl") == []       # the old reject is gone


def test_reload_difference_keeps_multiplicities(spark):
    a = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (4, "z")], "k int, v string")
    got = {(r.k, r.v, r.change): r.n for r in parquet.changes_between(a, b).collect()}
    assert got == {(1, None, "unchanged"): 1, (1, None, "vanished"): 2, (2, "x", "unchanged"): 1, (2, "x", "added"): 1,
                   (3, "y", "vanished"): 1, (4, "z", "added"): 1}


def test_carriage_returns_as_the_pattern_takes_them(spark, scratch):
    path = scratch("crs")
    texts = ["a\r", "a\r\r", "a\rb", "\r", "a|b", ""]
    spark.createDataFrame([(x,) for x in texts], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    got = sorted(r.value for r in delimited.read_lines(spark, path).collect())
    by_pattern = spark.createDataFrame([(x,) for x in texts], "v string").select(F.regexp_replace("v", "\r$", "").alias("v"))
    assert got == sorted(r.v for r in by_pattern.collect())


def test_compressed_lines_come_back_whole(spark, scratch, monkeypatch):
    path, n = local_path(scratch("compressed")), 3000
    lines = spark.range(0, n, 1, 2).select(F.expr(
        "case when id % 7 = 0 then '' when id % 11 = 0 then NULL else concat('é|', id, '|x\ry|', repeat('z', id % 90)) end").alias("value"))
    monkeypatch.setattr(delimited, "MAX_LINES_PER_FILE", 1000)
    delimited.write_lines(lines, path, partition_by=None, compressed=True)
    sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]
    assert len(sizes) == 4 and sum(sizes) * 3 < lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")         # a compressed file is not cut
    try:
        got = sorted(r.value for r in delimited.read_lines(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert got == sorted(r.value or "" for r in lines.collect())


def test_a_carriage_return_inside_a_line_is_text_before_any_character(spark, scratch):
    path, texts = scratch("inner-crs"), ["a\r\u2028", "a\r\x85", "a\u2028\r"]
    spark.createDataFrame([(x,) for x in texts], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert sorted(r.value for r in delimited.read_lines(spark, path).collect()) == sorted([*texts[:2], "a\u2028"])


def test_blocks_are_cut_as_lines_one_by_one(spark, scratch, monkeypatch):
    root = local_path(scratch("blocks"))
    os.makedirs(root)
    text = "\n\r\na\r\r\nŁ\u2028\x0bx\ry|é\r\n\n\n" + "".join(f"{'z' * (i % 90)}|€{i}\r\n" for i in range(400)) + "no end\r"
    _zip(os.path.join(root, "ccl_2024.zip"), {"ccl.txt": text})
    want = [v[:-1] if v.endswith("\r") else v for v in text.split("\n")]
    for size in (7, 200, 1 << 20):
        monkeypatch.setattr(zipsource, "BLOCK", size)
        reader = zipsource.BulkZipReader({"file_type": "ccl", "path": root})
        batches = list(reader.read(reader.partitions()[0]))
        assert [v for b in batches for v in b.column("value").to_pylist()] == want
        assert {(b.column("cycle")[0].as_py(), b.column("member")[0].as_py()) for b in batches} == {(2024, "ccl.txt")}


def test_a_load_asks_for_the_columns_it_uses(spark, scratch, monkeypatch):
    root, raw = local_path(scratch("columns")), scratch("columns-raw")
    os.makedirs(root)
    _zip(os.path.join(root, "ccl_2024.zip"), {"ccl.txt": "a|b|c|d|e|f|g\nshort\n"})
    asked, written = [], []
    real, write = zipsource.read_zip_lines, parquet.write_raw
    monkeypatch.setattr(zipsource, "read_zip_lines", lambda *a, **k: asked.append(out := real(*a, **k)) or out)
    monkeypatch.setattr(parquet, "write_raw", lambda df, *a, **k: written.append(df) or write(df, *a, **k))
    assert [tuple(r) for r in load.load_zip_to_raw(spark, root, "ccl", raw).collect()] == [("ccl", 2024, 1, 1)]
    assert asked[0].columns == ["value", "cycle"]        # no path and no member with every line from Python
    # what the write needs sorted is sorted as lines, and only then cut into fields
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project [if") < plan.index("Sort [cycle") and plan.count("replace(") == 0
    assert tuple(spark.read.parquet(f"{raw}/_rejects/ccl").first()) == ("short", 1, 2024)


def test_archives_repeat_every_tenth_line_across_batches(spark, scratch):
    path = scratch("zip-batches")
    raw = spark.range(95).selectExpr(*[f"concat('é{j}-', id) AS {c}" for j, c in enumerate(schemas.column_names("ccl"))],
                                     "CAST(if(id < 60, 2022, 2024) AS int) AS cycle").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        made = zipwriter.write_zip_archives(raw, path, "ccl").orderBy("cycle").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [(r.cycle, r.n_lines) for r in made] == [(2022, 60), (2024, 35)]
    for r in made:
        with zipfile.ZipFile(local_path(r.archive)) as z:
            lines = z.read("ccl.txt").decode().splitlines()
            first = 0 if r.cycle == 2022 else 60
            assert lines == ["|".join(f"é{j}-{i}" for j in range(7)) for i in range(first, first + r.n_lines)]
            assert z.read(f"by_date/itcont_{r.cycle}_partial.txt").decode().splitlines() == lines[::10]
