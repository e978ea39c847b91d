import datetime as dt

import pytest
from pyspark.sql import functions as F

from tableops.operators import upsert
from helpers import rows

SCHEMA = "id int, name string, seg string, bal double"


def _pair(spark):
    target = spark.createDataFrame([(1, "a", "x", 1.0), (2, "b", "y", 2.0), (3, "c", "z", 3.0)], SCHEMA)
    source = spark.createDataFrame([(2, "B", None, 20.0), (4, "D", "w", 40.0)], SCHEMA)
    return target, source


def test_upsert_replaces_inserts_and_keeps(spark):
    t, s = _pair(spark)
    got = upsert.upsert(t, s, ["id"])
    assert rows(got) == [(1, "a", "x", 1.0), (2, "B", None, 20.0), (3, "c", "z", 3.0), (4, "D", "w", 40.0)]


def test_upsert_idempotent(spark):
    t, s = _pair(spark)
    once = upsert.upsert(t, s, ["id"])
    assert rows(upsert.upsert(once, s, ["id"])) == rows(once)


def test_upsert_duplicate_source_key_fails(spark):
    t, _ = _pair(spark)
    s = spark.createDataFrame([(4, "D", "w", 1.0), (4, "E", "w", 2.0)], SCHEMA)
    with pytest.raises(Exception, match="more than one row"):
        upsert.upsert(t, s, ["id"]).collect()
    got = upsert.upsert(t, s, ["id"], on_duplicate="first", order=["bal"])
    assert (4, "E", "w", 2.0) in rows(got)


def test_upsert_null_key_fails(spark):
    t, _ = _pair(spark)
    s = spark.createDataFrame([(None, "n", "w", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="NULL key"):
        upsert.upsert(t, s, ["id"]).collect()


def test_merge_partial_keeps_unlisted_fields(spark):
    t, s = _pair(spark)
    got = upsert.merge_partial(t, s, ["id"], ["seg", "bal"])
    # id 2: name survives from target, seg overwritten by NULL, bal overwritten; id 4 inserted whole
    assert rows(got) == [(1, "a", "x", 1.0), (2, "b", None, 20.0), (3, "c", "z", 3.0), (4, "D", "w", 40.0)]


def test_update_from_matched_null_overwrites_and_count_is_kept(spark):
    t, s = _pair(spark)
    got = upsert.update_from(t, s, ["id"], {"seg": "seg", "bal": lambda c: c("bal") * 2}, matched_col="m")
    assert rows(got) == [(1, "a", "x", 1.0, False), (2, "b", None, 40.0, True), (3, "c", "z", 3.0, False)]
    assert got.count() == t.count()


def test_update_from_where_and_pairs(spark):
    t, _ = _pair(spark)
    src = spark.createDataFrame([(1, "NEW"), (3, "NEW3")], "pk int, label string")
    got = upsert.update_from(t, src, [("id", "pk")], {"name": "label"}, where=lambda tc, sc: tc("bal") > 1.5)
    assert rows(got, "id", "name") == [(1, "a"), (2, "b"), (3, "NEW3")]


def test_update_from_duplicate_fails(spark):
    t, _ = _pair(spark)
    src = spark.createDataFrame([(1, "x"), (1, "y")], "id int, label string")
    with pytest.raises(Exception, match="more than one row"):
        upsert.update_from(t, src, ["id"], {"name": "label"}).collect()


def test_close_open_intervals(spark):
    d = dt.date
    data = [
        # key 1: one open row only -> unchanged
        (1, 1, d(2020, 1, 1), None),
        # key 2: two open rows with a closed one between them
        (2, 2, d(2020, 1, 1), None),
        (2, 3, d(2020, 2, 1), d(2020, 2, 10)),
        (2, 4, d(2020, 3, 1), None),
        # key 3: same start twice, tie broken by id
        (3, 5, d(2021, 1, 1), None),
        (3, 6, d(2021, 1, 1), None),
        (3, 7, d(2021, 5, 1), None),
    ]
    df = spark.createDataFrame(data, "k int, id int, s date, e date")
    got = upsert.close_open_intervals(df, "k", "s", "e", "id", changed_col="changed")
    assert rows(got, "id", "e", "changed") == [
        (1, None, False),
        (2, d(2020, 1, 31), True),
        (3, d(2020, 2, 10), False),
        (4, None, False),
        (5, d(2020, 12, 31), True),
        (6, d(2021, 4, 30), True),
        (7, None, False),
    ]


def test_limit_per_group_hot_key(spark):
    data = [(0, i) for i in range(300)] + [(k, i) for k in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(data, "k int, v int")
    res = rows(upsert.limit_per_group(df, ["k"], 5, ["v"], descending=True))
    assert [v for k, v in res if k == 0] == [295, 296, 297, 298, 299]
    assert len([1 for k, _ in res if k == 1]) == 3
    assert [v for k, v in rows(upsert.limit_per_group(df, ["k"], 5, ["v"])) if k == 0] == [0, 1, 2, 3, 4]


def test_duplicate_source_keys_fail_whatever_is_read(spark):
    t = spark.createDataFrame([(1, "a", 1.0)], "id int, name string, bal double")
    s = spark.createDataFrame([(7, "x", 1.0), (7, "y", 2.0)], "id int, name string, bal double")
    for merged in (upsert.upsert(t, s, ["id"]), upsert.merge_partial(t, s, ["id"], ["bal"])):
        for read in (lambda d: d.count(), lambda d: d.select("id").collect(), lambda d: d.select("name").collect()):
            with pytest.raises(Exception, match="more than one row"):
                read(merged)


def test_same_id_under_two_partition_keys(spark):
    t = spark.createDataFrame([(1, 10, "a")], "centre int, id int, v string")
    s = spark.createDataFrame([(2, 10, "b")], "centre int, id int, v string")
    assert rows(upsert.upsert(t, s, ["centre", "id"]), "centre", "id", "v") == [(1, 10, "a"), (2, 10, "b")]
