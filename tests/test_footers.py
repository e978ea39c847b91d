"""Latest values from footers equal the scan, also where files lack statistics."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from helpers import rows
from pyspark.sql import functions as F

from tableops.sources.footers import footer_facts, latest_by_footers, row_group_max

COLUMNS = ["ts", "tz", "day", "old", "none"]


def table(n, start):
    at = [dt.datetime(2020, 1, 1) + dt.timedelta(hours=(start + i) * 7 % 5000, microseconds=i) for i in range(n)]
    return pa.table(
        {
            "ts": pa.array([None if i % 5 == 0 else x for i, x in enumerate(at)], pa.timestamp("us")),
            "tz": pa.array(at, pa.timestamp("ms", tz="UTC")),
            "day": pa.array([x.date() for x in at], pa.date32()),
            "old": pa.array([dt.datetime(1950, 1, 1, 1, 1, 1) - dt.timedelta(days=i) for i in range(n)], pa.timestamp("us")),
            "none": pa.array([None] * n, pa.timestamp("us")),
            "text": pa.array(["x" * 200] * n),
        },
    )


def land(path):
    os.makedirs(path)
    pq.write_table(table(900, 0), f"{path}/a.parquet", row_group_size=250)
    pq.write_table(table(800, 3), f"{path}/b.parquet", write_statistics=False)
    pq.write_table(table(700, 9), f"{path}/c.parquet", use_deprecated_int96_timestamps=True)
    pq.write_table(table(50, 5).drop_columns(["old"]), f"{path}/d.parquet")
    pq.write_table(table(0, 0), f"{path}/e.parquet")


def test_equals_the_scan(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    land(path)
    parts = [pq.read_table(f"{path}/{f}") for f in sorted(os.listdir(path))]
    want = []
    for c in COLUMNS:
        have = [p.column(c).cast(pa.timestamp("us", tz="UTC") if c == "tz" else pa.timestamp("us")) for p in parts if c in p.column_names]
        known = [x.replace(tzinfo=None) for h in have for x in h.to_pylist() if x is not None]
        want.append((c, max(known, default=None), sum(len(h) for h in have)))
    got = [tuple(r) for r in latest_by_footers(spark, path, [*COLUMNS, "missing"]).collect()]
    assert sorted(got) == sorted(want)


def test_only_row_groups_without_statistics_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    land(path)
    facts = footer_facts(spark, path, ["ts", "day"]).withColumn("file", F.element_at(F.split("path", "/"), -1))
    scanned = {(r["file"], r["column_name"]): r["n_scanned"] for r in facts.collect()}
    assert scanned[("a.parquet", "ts")] == 0 and scanned[("a.parquet", "day")] == 0
    assert scanned[("b.parquet", "ts")] == 1 and scanned[("c.parquet", "ts")] == 1 and scanned[("c.parquet", "day")] == 0


class Counting:
    """A file that counts the bytes read from it."""

    def __init__(self, path):
        self.f, self.read_bytes, self.closed = open(path, "rb"), 0, False

    def read(self, n=-1):
        data = self.f.read(n)
        self.read_bytes += len(data)
        return data

    def seek(self, *a):
        return self.f.seek(*a)

    def tell(self):
        return self.f.tell()

    def close(self):
        self.closed = True


def test_bytes_read_do_not_follow_the_rows(tmp_dir):
    read = []
    for n in (1_000, 200_000):
        path = f"{tmp_dir}/{n}.parquet"
        pq.write_table(table(n, 0), path, row_group_size=n)
        counting = Counting(path)
        f = pq.ParquetFile(counting)
        top, scanned = row_group_max(f, 0, "ts")
        assert not scanned and top == max(x for x in table(n, 0).column("ts").cast(pa.int64()).to_pylist() if x is not None)
        read.append(counting.read_bytes)
    assert read[1] < 2 * read[0] + 70_000 and read[1] < os.path.getsize(path) / 3


def test_empty_folder_and_rows_helper(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    os.makedirs(path)
    assert rows(latest_by_footers(spark, path, ["ts"])) == []
