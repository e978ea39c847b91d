"""Avro capture files: read in runs of blocks, whatever the cut."""

import json
import os
import random

import pytest
from helpers import rows

from tableops.sources import capture, read_capture, write_capture
from tableops.sources.ranges import list_files


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        assert n >= 0
        return self.data[at : at + n]


def events(n, seed=1):
    rng = random.Random(seed)
    body = lambda: None if rng.random() < 0.1 else bytes(rng.randrange(256) for _ in range(rng.randrange(60)))
    return [(rng.choice([i, -i, i << 40]), str(i * 96), f"é {i}", body()) for i in range(n)]


def written(spark, folder, data, codec, parts=3, **kw):
    df = spark.createDataFrame(data, capture.ROW).repartition(parts)
    return write_capture(df, folder, codec, **kw)


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_round_trip_in_runs(spark, tmp_dir, codec):
    data = events(2000)
    paths = written(spark, f"{tmp_dir}/c", data, codec, block_records=37)
    assert len(paths) == 3
    for step in (1 << 30, 5000):
        got = read_capture(spark, f"{tmp_dir}/c", step)
        assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(data, capture.ROW).collect()))
    size = sum(r["length"] for r in list_files(spark, f"{tmp_dir}/c").collect())
    assert got.rdd.getNumPartitions() >= size // 5000


def test_every_cut_has_every_block_once(spark, tmp_dir):
    (path,) = written(spark, f"{tmp_dir}/c", events(300), "null", parts=1, block_records=7)
    data = open(path.removeprefix("file:"), "rb").read()
    whole = [(n, d) for _, n, d in capture.blocks(Bytes(data), len(data), 0, len(data))]
    assert sum(n for n, _ in whole) == 300
    for step in (16, 17, 100, 331, 5000):
        cut = [(n, d) for b in range(0, len(data), step) for _, n, d in capture.blocks(Bytes(data), len(data), b, min(b + step, len(data)))]
        assert cut == whole


def test_damage_and_foreign_files(spark, tmp_dir):
    (path,) = written(spark, f"{tmp_dir}/c", events(100), "null", parts=1)
    raw = open(path.removeprefix("file:"), "rb").read()
    for name, data, why in (("cut", raw[:-9], "marker"), ("flip", raw[:-3] + b"xyz", "marker"), ("text", b"hello world, this is text", "not an Avro")):
        folder = f"{tmp_dir}/{name}"
        os.makedirs(folder)
        with open(f"{folder}/x.avro", "wb") as f:
            f.write(data)
        with pytest.raises(Exception, match=why):
            read_capture(spark, folder).collect()


def test_other_fields_and_types_are_stepped_over():
    schema = {
        "type": "record",
        "name": "E",
        "fields": [
            {"name": "Flag", "type": "boolean"},
            {"name": "SystemProperties", "type": {"type": "map", "values": ["long", "double", "string", "bytes"]}},
            {"name": "Body", "type": "bytes"},
            {"name": "Weight", "type": ["null", "float"]},
            {"name": "Offset", "type": "string"},
        ],
    }
    one = b"\x01" + capture._long(2) + capture._text(b"a") + capture._long(0) + capture._long(-77)
    one += capture._text(b"b") + capture._long(2) + capture._text(b"x") + capture._long(0)
    one += capture._text(b"body") + capture._long(1) + b"\x00\x00\x80?" + capture._text(b"96")
    cursor = capture.Cursor(one * 2)
    want = (True, {"a": -77, "b": "x"}, b"body", 1.0, "96")
    assert cursor.value(json.loads(json.dumps(schema))) == want and cursor.value(schema) == want and cursor.at == 2 * len(one)
    for n in (0, -1, 63, 64, -(2**63), 2**63 - 1):
        assert capture.Cursor(capture._long(n)).long() == n


def test_empty(spark, tmp_dir):
    assert written(spark, f"{tmp_dir}/c", [], "null") == []
    os.makedirs(f"{tmp_dir}/none")
    assert rows(read_capture(spark, f"{tmp_dir}/none")) == []
