"""Tie-safe extracts with a commit log, and tables whose files have different schemas."""

import datetime as dt
import os

import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tableops.sources import ExtractLog, extract_new, read_generations
from tableops.sources.extract_log import Extract
from tableops.sources.generations import join_types

SCHEMA = "id bigint, ts timestamp_ntz, v string"


def at(h):
    return dt.datetime(2024, 1, 1, h, 0, 0, 123456)


def frame(spark, pairs):
    return spark.createDataFrame([(i, at(h), f"v{i}") for i, h in pairs], SCHEMA)


def test_rows_at_the_watermark_come_exactly_once(spark, tmp_dir):
    log = ExtractLog(spark, f"{tmp_dir}/x")
    there = [(1, 1), (2, 5), (9, 5)]
    assert extract_new(frame(spark, there), log, "ts", ["id"]).rows == 3
    there += [(3, 5), (4, 5)]  # late, with the watermark's own time, ids below and above those taken
    assert extract_new(frame(spark, there), log, "ts", ["id"]) == Extract(2, "2024-01-01 05:00:00.123456", 2)
    there += [(5, 5), (6, 7)]
    assert extract_new(frame(spark, there), log, "ts", ["id"]).rows == 2
    assert extract_new(frame(spark, there), log, "ts", ["id"]) is None
    got = log.read(frame(spark, []).schema)
    assert rows(got, "id", "extract") == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (9, 1)]
    assert rows(got, "id", "ts", "v") == rows(frame(spark, there))


def test_failed_extract_leaves_no_mark(spark, tmp_dir, monkeypatch):
    log = ExtractLog(spark, f"{tmp_dir}/x")
    extract_new(frame(spark, [(1, 1)]), log, "ts", ["id"])
    with monkeypatch.context() as m:
        m.setattr(ExtractLog, "commit", lambda self, entry: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            extract_new(frame(spark, [(1, 1), (2, 2), (3, 3)]), log, "ts", ["id"])
    assert os.path.isdir(log.data(2)) and [e.number for e in log.entries()] == [1]
    assert rows(log.read(frame(spark, []).schema), "id") == [(1,)]  # its files are there, but not part of the log
    assert extract_new(frame(spark, [(1, 1), (2, 2)]), log, "ts", ["id"]).rows == 1


def test_entries_are_never_overwritten(spark, tmp_dir):
    log = ExtractLog(spark, f"{tmp_dir}/x")
    log.commit(Extract(1, "a", 1))
    with pytest.raises(RuntimeError, match="another run"):
        log.commit(Extract(1, "b", 2))
    assert log.entries() == [Extract(1, "a", 1)]


def test_null_times_and_empty_tables(spark, tmp_dir):
    log = ExtractLog(spark, f"{tmp_dir}/x")
    assert extract_new(frame(spark, []), log, "ts", ["id"]) is None and log.entries() == []
    assert log.read(frame(spark, []).schema).count() == 0
    with pytest.raises(Exception, match="cannot be extracted by time"):
        extract_new(spark.createDataFrame([(1, None, "x")], SCHEMA), log, "ts", ["id"])


def test_three_generations_in_one_call(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(1, 7, 1)], "a int, b int, c int").write.parquet(f"{path}/0")
    spark.createDataFrame([(2**40, "x", dt.date(2024, 1, 2))], "a bigint, b string, d date").write.parquet(f"{path}/1")
    spark.createDataFrame([(3, None, dt.datetime(2024, 1, 2, 3))], "a int, b string, d timestamp_ntz").write.parquet(f"{path}/2")
    got = read_generations(spark, path)
    assert got.dtypes == [("a", "bigint"), ("b", "string"), ("c", "int"), ("d", "timestamp_ntz")]
    assert rows(got) == rows(
        spark.createDataFrame(
            [(1, "7", 1, None), (2**40, "x", None, dt.datetime(2024, 1, 2)), (3, None, None, dt.datetime(2024, 1, 2, 3))], got.schema
        )
    )


def test_impossible_pair_is_named(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(1, 7)], "a int, b bigint").write.parquet(f"{path}/0")
    spark.createDataFrame([(1, (2,))], "a int, b struct<x:int>").write.parquet(f"{path}/1")
    with pytest.raises(ValueError, match="'b' cannot be read as one type: bigint .*/0/.* and struct<x:int> .*/1/"):
        read_generations(spark, path)
    with pytest.raises(ValueError, match="no Parquet file"):
        os.makedirs(f"{tmp_dir}/none")
        read_generations(spark, f"{tmp_dir}/none")


TYPES = [
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(9, 2), T.DecimalType(20, 0), T.DecimalType(38, 30),
    T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(), T.BooleanType(), T.StringType(), T.BinaryType(), T.NullType(),
]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(TYPES), st.sampled_from(TYPES))
def test_joins_are_symmetric_and_idempotent(a, b):
    joined = join_types(a, b)
    assert join_types(b, a) == joined and join_types(a, a) == a
    if joined is not None:
        assert join_types(joined, a) == joined and join_types(joined, b) == joined


def test_joins_of_numbers():
    assert join_types(T.IntegerType(), T.DecimalType(9, 2)) == T.DecimalType(12, 2)
    assert join_types(T.LongType(), T.DecimalType(38, 30)) is None
    assert join_types(T.LongType(), T.DoubleType()) is None and join_types(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert join_types(T.BinaryType(), T.StringType()) is None
