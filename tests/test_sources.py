import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tableops.functions import date_path
from tableops.plans.file_jobs import q_json_array_load
from tableops.sinks import unload_partition, write_csv_stamped, write_date_folders, write_json_parts
from tableops.sources import (
    catalog_columns, incremental, next_watermark, read_delimited, read_json_array, read_json_payload, read_matching,
    read_sheets, sheet_layouts, typed_fields, with_lineage,
)
from tableops.streaming import ingest_new_files
from helpers import rows


def _write(path, name, lines, enc="utf-8"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding=enc) as f:
        f.write("\n".join(lines) + "\n")


def test_read_json_payload_keeps_bad_lines_and_lineage(spark, tmp_dir):
    _write(tmp_dir, "a.json", ['{"k": 1, "v": "1.5"}', "not json", '{"k": 3, "v": "x"}'])
    _write(tmp_dir, "b.json", ['{"k": 4}'])
    _write(tmp_dir, "skip.txt", ['{"k": 99}'])
    raw = read_json_payload(spark, tmp_dir, regex=r".*\.json")
    typed = typed_fields(raw, "payload", {"k": ("k", "int"), "v": ("v", "decimal(15,5)")})
    out = with_lineage(typed, dt.datetime(2024, 1, 1))
    got = rows(out.select(F.col("etl_metadata_filename").substr(-6, 6).alias("f"), "etl_metadata_file_row_number", "k", "v"))
    assert [(f, n, k, None if v is None else float(v)) for f, n, k, v in got] == [
        ("a.json", 1, 1, 1.5), ("a.json", 2, None, None), ("a.json", 3, 3, None), ("b.json", 1, 4, None)
    ]


def test_parquet_lineage_uses_row_index(spark, tmp_dir):
    spark.range(5).coalesce(1).write.parquet(tmp_dir + "/p")
    out = with_lineage(spark.read.parquet(tmp_dir + "/p"))
    assert rows(out.select("id", "etl_metadata_file_row_number")) == [(i, i + 1) for i in range(5)]


def test_read_matching_prunes_by_name(spark, tmp_dir):
    _write(tmp_dir, "202108 forecast.json", ['{"a": 1}'])
    _write(tmp_dir, "x202108 forecast.json", ['{"a": 2}'])  # regex is anchored at the start
    _write(tmp_dir, "202109 budget.json", ['{"a": 3}'])
    df = read_matching(spark, tmp_dir, "json", r"\d{6}.*forecast", schema="a int")
    assert rows(df.select("a")) == [(1,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "file_name" in plan


def test_read_delimited_latin1_by_position(spark, tmp_dir):
    _write(tmp_dir, "c.csv", ["h1;h2;h3", "1;Ærlig;2", "2;Øst;"], enc="latin-1")
    df = read_delimited(spark, tmp_dir, "a string, b string, c int", sep=";", encoding="ISO-8859-1")
    assert rows(df) == [("1", "Ærlig", 2), ("2", "Øst", None)]


def test_read_json_array_gzip(spark, tmp_dir):
    with gzip.open(os.path.join(tmp_dir, "x.json.gz"), "wt") as f:
        json.dump([{"a": 1}, {"a": 2}], f)
    assert rows(read_json_array(spark, tmp_dir, "a int")) == [(1,), (2,)]


def test_array_files_follow_the_rows_not_the_keys(spark, tmp_dir):
    keys = [None, 7, 7, *range(0, 40_000, 200)]  # far apart, repeated, null
    data = [(k, f"c{k}", None if i % 50 == 0 else i % 3, i / 4) for i, k in enumerate(keys)]
    table = spark.createDataFrame(data, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")
    table.coalesce(1).write.parquet(tmp_dir + "/customer.parquet")
    want = sorted([(k, name, balance) for k, name, _, balance in data], key=str)
    for file_rows, runs in ((1 << 17, 1), (50, 5)):
        df = q_json_array_load(spark, tmp_dir, file_rows=file_rows)
        assert sorted([tuple(r) for r in df.collect()], key=str) == want
        files = df.groupBy(F.input_file_name()).count().collect()
        assert len(files) <= 4 * runs and max(r["count"] for r in files) <= file_rows
    assert len(files) > 4


def test_read_sheets_one_scan(spark, tmp_dir):
    for wb in ["202108 forecast", "notes"]:
        for sheet in ["NMU", "Drop"]:
            _write(f"{tmp_dir}/{wb}/{sheet}", "part.csv", ["CC,jan-21", f"1,{len(sheet)}"])
    df = read_sheets(spark, tmp_dir, regex=r"\d{6}.*forecast")
    assert rows(df.select("workbook", "sheet", "CC")) == [("202108 forecast", "Drop", "1"), ("202108 forecast", "NMU", "1")]


def test_sheets_are_matched_by_their_own_headers(spark, tmp_dir):
    base = f"{tmp_dir}/202108 forecast"
    _write(f"{tmp_dir}/000 notes/A", "p.csv", ["foo,CC", "1,2"])  # sorts first, not selected
    _write(f"{base}/A", "p.csv", ["CC,jan-21,feb-21", "1,10,20"])
    _write(f"{base}/B", "p.csv", ["CC,feb-21,jan-21", "2,200,100"])
    _write(f"{base}/C", "p.csv", ["CC,mar-21", "3,3000"])
    df = read_sheets(spark, tmp_dir, regex=r"\d{6}.*forecast")
    got = {r.sheet: r for r in df.collect()}
    assert set(got) == {"A", "B", "C"}
    assert (got["A"]["jan-21"], got["A"]["feb-21"], got["B"]["jan-21"], got["B"]["feb-21"]) == ("10", "20", "100", "200")
    assert got["C"]["mar-21"] == "3000" and got["C"]["jan-21"] is None
    assert len(sheet_layouts(spark, tmp_dir, regex=r"\d{6}.*forecast")) == 3
    with pytest.raises(ValueError, match="no sheet"):
        read_sheets(spark, tmp_dir, regex="nothing")


def test_rows_of_text_files_are_numbered_across_blocks(spark, tmp_dir):
    n = 4000
    _write(tmp_dir + "/t", "a.json", [json.dumps({"i": i}) for i in range(n)])
    _write(tmp_dir + "/t", "b.json", [json.dumps({"i": i}) for i in range(7)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        raw = read_json_payload(spark, tmp_dir + "/t")
        assert raw.rdd.getNumPartitions() > 3
        got = with_lineage(raw).selectExpr("int(get_json_object(payload_text, '$.i')) AS i", "etl_metadata_file_row_number AS r").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert len(got) == n + 7 and all(r.r == r.i + 1 for r in got)


def test_more_batches_than_progress_is_kept_for(spark, tmp_dir):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            _write(tmp_dir + "/in", f"{i}.json", [f'{{"id": {i}}}'])
        kw = dict(sink=tmp_dir + "/out", checkpoint=tmp_dir + "/ckpt", max_files_per_trigger=1)
        assert ingest_new_files(spark, tmp_dir + "/in", "id long", transform=lambda d: d.where("id <> 3"), **kw) == 4
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_unload_partition_dynamic_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    unload_partition(df, tmp_dir + "/u", ["p"])
    unload_partition(spark.createDataFrame([(2, "c")], "p int, v string"), tmp_dir + "/u", ["p"])
    assert rows(spark.read.parquet(tmp_dir + "/u").select("p", "v")) == [(1, "a"), (2, "c")]


def test_json_parts_and_stamped_csv(spark, tmp_dir):
    df = spark.createDataFrame([("f", "m1", dt.datetime(2024, 1, 1, 0, 0, 0, 123456))], "file string, metric string, ts timestamp_ntz")
    write_json_parts(df.withColumns({"fp": F.col("file"), "mp": F.col("metric")}), tmp_dir + "/j", ["fp", "mp"])
    assert os.path.isdir(tmp_dir + "/j/fp=f/mp=m1")
    path = write_csv_stamped(df, tmp_dir + "/club", dt.datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("club_20240506-070809")
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["file", "metric", "ts"]


def test_incremental_strict_watermark(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, _ts long")
    assert incremental(df, "_ts").count() == 3
    new = incremental(df, "_ts", 20)
    assert rows(new.select("id")) == [(3,)]
    assert next_watermark(new, "_ts", 20).collect()[0][0] == 30
    assert next_watermark(incremental(df, "_ts", 30), "_ts", 30).collect()[0][0] == 30


def test_ingest_new_files_loads_each_file_once(spark, tmp_dir):
    src = tmp_dir + "/in"
    _write(src, "1.json", ['{"id": 1}', '{"id": 2}'])
    kw = dict(sink=tmp_dir + "/out", checkpoint=tmp_dir + "/ckpt")
    assert ingest_new_files(spark, src, "id long", **kw) == 2
    assert ingest_new_files(spark, src, "id long", **kw) == 0
    _write(src, "2.json", ['{"id": 3}'])
    assert ingest_new_files(spark, src, "id long", transform=lambda d: d.withColumn("x", F.col("id") * 2), **kw) == 1
    assert rows(spark.read.parquet(tmp_dir + "/out").select("id")) == [(1,), (2,), (3,)]


def test_catalog_columns_and_date_path(spark):
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, etl_createdatetime timestamp").createOrReplaceTempView("t_a")
    spark.createDataFrame([(1,)], "id int").createOrReplaceTempView("t_b")
    got = rows(catalog_columns(spark, ["t_a", "t_b"], names=["ETL_CREATEDATETIME"], exclude=["t_b"]))
    assert got == [("t_a", "etl_createdatetime")]
    d = spark.createDataFrame([(dt.date(2021, 10, 12),)], "d date").select(date_path("d")).collect()[0][0]
    assert d == "2021/10/12/"


def test_clustered_unload_splits_hot_partition(spark, tmp_dir):
    # one partition value holds 90 % of the rows: clustered output spreads it over several files
    data = [(2020 if i % 10 else 2021, i) for i in range(2000)]
    df = spark.createDataFrame(data, "y int, pk int")
    unload_partition(df, tmp_dir + "/c", ["y"], cluster_by=["pk"])
    files = [f for f in os.listdir(tmp_dir + "/c/y=2020") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(tmp_dir + "/c").count() == 2000


def test_date_folders_from_one_write(spark, tmp_dir):
    base = f"{tmp_dir}/days"
    df = spark.createDataFrame([(i, dt.date(2024, 1, 30 + i % 2)) for i in range(9)], "id int, day date")
    assert write_date_folders(df, base, "day") == 2
    assert sorted(os.listdir(f"{base}/2024/01")) == ["30", "31"] and os.listdir(base) == ["2024"]
    assert rows(spark.read.parquet(f"{base}/2024/01/31"), "id") == [(1,), (3,), (5,), (7,)]
    again = spark.createDataFrame([(99, dt.date(2024, 1, 31))], "id int, day date")
    assert write_date_folders(again, base, "day") == 1
    assert rows(spark.read.option("recursiveFileLookup", "true").parquet(base), "id") == [(0,), (2,), (4,), (6,), (8,), (99,)]
    with pytest.raises(Exception, match="has no folder"):
        write_date_folders(spark.createDataFrame([(1, None)], "id int, day date"), base, "day")
