"""Partition-wise merges and streaming upserts: equal to the whole-table form, other partitions untouched, repeatable."""

import os

import pytest
from helpers import rows

from tableops.operators.upsert import merge_partial, upsert
from tableops.sinks import merge_partitions
from tableops.streaming import upsert_new_files
from tableops.streaming.upsert import Ledger

SCHEMA = "center string, id bigint, name string, at int"
KEYS = ["center", "id"]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def store(spark, path, n=40):
    df = spark.createDataFrame([(f"0{i % 5}", i, f"n{i}", 1) for i in range(n)], SCHEMA)
    merge_partitions(spark, path, df, KEYS, ["center"], n=3)
    return df


def read(spark, path):
    return spark.read.schema(SCHEMA).parquet(path).select("center", "id", "name", "at")


def test_equals_upsert_and_keeps_other_files(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    target = store(spark, path)
    assert rows(read(spark, path)) == rows(target)  # "01" stays text
    before = files(path)
    source = spark.createDataFrame([("01", 1, "new", 2), ("01", 77, None, 2), ("09", 1, "other", 2)], SCHEMA)
    assert sorted(merge_partitions(spark, path, source, KEYS, ["center"])) == ['{"center":"01"}', '{"center":"09"}']
    assert rows(read(spark, path)) == rows(upsert(target, source, KEYS))
    after = files(path)
    assert {f for f in before if "center=01" not in f} == {f for f in after if "center=01" not in f and "center=09" not in f}
    assert not before & {f for f in after if "center=01" in f}


def test_partial_fields_and_empty_source(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    target, before = store(spark, path), files(path)
    nothing = spark.createDataFrame([], SCHEMA)
    assert merge_partitions(spark, path, nothing, KEYS, ["center"]) == [] and files(path) == before
    source = spark.createDataFrame([("02", 2, "new", None), ("02", 99, "x", 3)], SCHEMA)
    merge_partitions(spark, path, source, KEYS, ["center"], fields=["at"])
    assert rows(read(spark, path)) == rows(merge_partial(target, source, KEYS, ["at"]))


def test_guards(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    store(spark, path)
    before = files(path)
    twice = spark.createDataFrame([("01", 1, "a", 1), ("01", 1, "b", 1)], SCHEMA)
    with pytest.raises(Exception, match="more than one row"):
        merge_partitions(spark, path, twice, KEYS, ["center"])
    with pytest.raises(Exception, match="NULL key"):
        merge_partitions(spark, path, spark.createDataFrame([("01", None, "a", 1)], SCHEMA), KEYS, ["center"])
    with pytest.raises(ValueError, match="not part of the key"):
        merge_partitions(spark, path, twice, ["id"], ["center"])
    assert files(path) == before


def test_newest_wins_whatever_the_order(spark, tmp_dir):
    batches = [[("a", 1, "late", 1), ("a", 2, "x", 5)], [("a", 1, "new", 9), ("a", 1, "mid", 4)], [("a", 1, "old", 0), ("b", 1, "y", 1)]]
    want = [("a", 1, "new", 9), ("a", 2, "x", 5), ("b", 1, "y", 1)]
    for k, order in enumerate(([0, 1, 2], [2, 1, 0, 1, 2])):
        for i in order:
            df = spark.createDataFrame(batches[i], SCHEMA)
            merge_partitions(spark, f"{tmp_dir}/{k}", df, KEYS, ["center"], newest=["at", "name"], on_duplicate="first")
        assert rows(read(spark, f"{tmp_dir}/{k}")) == want


def land(spark, path, k, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.json(f"{path}/{k}")


def test_stream_killed_between_publishing_and_ledger(spark, tmp_dir):
    landing, target, checkpoint = (f"{tmp_dir}/{x}" for x in ("landing", "target", "ckpt"))
    args = (spark, landing, SCHEMA, target, checkpoint, KEYS, ["center"], ["at", "name"])
    land(spark, landing, 0, [("01", 1, "a", 1), ("02", 1, "b", 1), ("01", 1, "c", 3)])
    assert upsert_new_files(*args) == 1
    assert rows(read(spark, target)) == [("01", 1, "c", 3), ("02", 1, "b", 1)]
    land(spark, landing, 1, [("01", 1, "late", 2), ("01", 2, "d", 1)])

    def killed(batch_id):
        raise RuntimeError("killed here")

    with pytest.raises(Exception, match="killed here"):
        upsert_new_files(*args, published=killed)
    want = [("01", 1, "c", 3), ("01", 2, "d", 1), ("02", 1, "b", 1)]
    assert rows(read(spark, target)) == want and Ledger(spark, checkpoint + "-ledger").entries().count() == 1
    assert upsert_new_files(*args) == 1  # the batch again
    assert rows(read(spark, target)) == want
    assert upsert_new_files(*args) == 0
    assert [r["batch"] for r in Ledger(spark, checkpoint + "-ledger").entries().orderBy("batch").collect()] == [0, 1]


def test_batch_in_the_ledger_is_skipped(spark, tmp_dir):
    landing, target, checkpoint = (f"{tmp_dir}/{x}" for x in ("landing", "target", "ckpt"))
    args = (spark, landing, SCHEMA, target, checkpoint, KEYS, ["center"], ["at", "name"])
    land(spark, landing, 0, [("01", 1, "a", 1)])
    assert upsert_new_files(*args) == 1
    before = files(target)
    for name in os.listdir(f"{checkpoint}/commits"):  # as if the stream died before its own commit
        os.remove(f"{checkpoint}/commits/{name}")
    assert upsert_new_files(*args) == 0 and files(target) == before
