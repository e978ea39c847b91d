"""Checked batch loads: committed whole or not visible at all."""

import os

import pyarrow as pa
import pytest
from helpers import rows

from tableops.operators import quality
from tableops.sinks import KeyedBatchSink, write_batches
from tableops.sinks.batches import ParquetStore, batches_of

SCHEMA = "center int, id bigint, name string"


def losing_sink():
    """A sink whose store takes one row less of one batch (classes made here travel to the workers by value)."""

    class LosingStore(ParquetStore):
        def put(self, key, batch, found):
            full = super().put(key, batch, found)
            return full - 1 if (key, batch) == ((3,), 1) else full

    class LosingSink(KeyedBatchSink):
        store = LosingStore

        @classmethod
        def name(cls):
            return "losing_batches"

    return LosingSink


def failing_sink():
    class FailingStore(ParquetStore):
        def put(self, key, batch, found):
            if key == (3,):
                raise RuntimeError("store is away")
            return super().put(key, batch, found)

    class FailingSink(KeyedBatchSink):
        store = FailingStore

        @classmethod
        def name(cls):
            return "failing_batches"

    return FailingSink


def plan(spark, tmp_dir, n=500):
    df = spark.createDataFrame([(3 if i % 3 else i % 7, i, f"n{i}") for i in range(n)], SCHEMA)
    path = f"{tmp_dir}/plan-{n}"
    quality.batch_plan(df, ["center"], 20, ["id"]).write.parquet(path)
    return spark.read.parquet(path)


def visible(path):
    return [d for d in (os.listdir(path) if os.path.isdir(path) else [])]


def test_commit_publishes_all_rows(spark, tmp_dir):
    p, path = plan(spark, tmp_dir), f"{tmp_dir}/store"
    write_batches(p, path, ["center"], "one")
    write_batches(p, path, ["center"], "two")
    got = spark.read.parquet(path)
    assert rows(got.where("load = 'one'").select(*p.columns)) == rows(p)
    assert sorted(visible(path)) == ["load=one", "load=two"] and got.count() == 2 * p.count()


@pytest.mark.parametrize("sink,why", [(losing_sink, "20 planned, 19 written"), (failing_sink, "store is away")])
def test_differing_or_failing_store_leaves_nothing(spark, tmp_dir, sink, why):
    path = f"{tmp_dir}/store"
    with pytest.raises(Exception, match=why):
        write_batches(plan(spark, tmp_dir), path, ["center"], "one", sink=sink())
    assert visible(path) == []


def test_lost_batch_is_noticed(spark, tmp_dir):
    """Rows that vanish between the plan and the sink: no store call differs, the totals do."""
    p, path = plan(spark, tmp_dir), f"{tmp_dir}/store"
    spark.dataSource.register(KeyedBatchSink)
    options = {"path": path, "keys": "center", "batch_col": "batch", "load": "x", "batches": 27, "rows": p.count()}
    lost = p.where("NOT (center = 3 AND batch = 2)").repartition(3, "center", "batch").sortWithinPartitions("center", "batch")
    with pytest.raises(Exception, match="none of those written"):
        lost.write.format("keyed_batches").mode("append").options(**options).save()
    assert visible(path) == []


def test_empty_plan(spark, tmp_dir):
    write_batches(plan(spark, tmp_dir, 0), f"{tmp_dir}/store", ["center"], "one")
    assert visible(f"{tmp_dir}/store") == []


def test_runs_cross_arrow_batches():
    pieces = [([1, 1, 2], [0, 0, 0]), ([2], [0]), ([], []), ([2, 2, 3], [0, 1, 0])]
    batches = [pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int64()), "b": pa.array(b, pa.int64())}) for k, b in pieces]
    assert [(key, t.num_rows) for key, t in batches_of(iter(batches), ["k", "b"])] == [((1, 0), 2), ((2, 0), 3), ((2, 1), 1), ((3, 0), 1)]
