"""Slice-wise numbering equals the plain window functions, also when one key holds most rows."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tableops.operators.ordered import dense_rank_global, lead_within, row_number_within, running_within, slice_bounds, slice_of


def _skewed(spark, n=400, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = 0 if i % 3 else rnd.randint(1, 20)  # key 0 holds two thirds of the rows
        data.append((key, rnd.randint(0, 50), i, rnd.choice([None, rnd.random()])))
    return spark.createDataFrame(data, "k int, start int, tb int, v double")


def test_row_number_within_matches_window(spark):
    df = _skewed(spark)
    got = row_number_within(df, ["k"], ["start", "tb"], out="rn", n=7)
    w = Window.partitionBy("k").orderBy("start", "tb")
    exp = df.withColumn("rn", F.row_number().over(w))
    assert sorted(got.select("tb", "rn").collect()) == sorted(exp.select("tb", "rn").collect())


def test_lead_within_matches_window(spark):
    df = _skewed(spark)
    got = lead_within(df, ["k"], ["start", "tb"], "start", "nxt", n=9)
    exp = df.withColumn("nxt", F.lead("start").over(Window.partitionBy("k").orderBy("start", "tb")))
    assert sorted(got.select("tb", "nxt").collect()) == sorted(exp.select("tb", "nxt").collect())


def test_lead_within_null_values_and_keys(spark):
    df = spark.createDataFrame(
        [(None, 1, 1, None), (None, 2, 2, 5.0), (1, 1, 3, None), (1, 2, 4, 1.0), (2, 1, 5, 2.0)],
        "k int, start int, tb int, v double",
    )
    got = lead_within(df, ["k"], ["start", "tb"], "v", "nxt", n=3)
    exp = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("k").orderBy("start", "tb")))
    assert sorted(got.select("tb", "nxt").collect()) == sorted(exp.select("tb", "nxt").collect())


def test_dense_rank_global_matches_window(spark):
    df = _skewed(spark).withColumn("score", (F.col("start") % 13).cast("double"))
    got = dense_rank_global(df, "score", descending=True, out="r", max_out="m", n=5)
    exp = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("score").desc())))
    assert sorted(got.select("tb", "r").collect()) == sorted(exp.select("tb", "r").collect())
    assert {r.m for r in got.select("m").distinct().collect()} == {13}


def test_dense_rank_global_ascending_with_nulls(spark):
    df = spark.createDataFrame([(1, 3.0), (2, None), (3, 1.0), (4, 3.0), (5, None)], "id int, x double")
    got = dense_rank_global(df, "x", descending=False, out="r", n=2)
    exp = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("x").asc())))
    assert sorted(got.select("id", "r").collect()) == sorted(exp.select("id", "r").collect())


def test_one_key_with_nearly_all_rows(spark):
    df = spark.range(0, 20_000, 1, 6).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(-1)).cast("int").alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("start"),
        F.col("id").cast("int").alias("tb"),
    )
    w = Window.partitionBy("k").orderBy("start", "tb")
    exp = df.select("tb", F.row_number().over(w).cast("long").alias("rn"), F.lead("tb").over(w).alias("nxt"))
    got = row_number_within(df, ["k"], ["start", "tb"], out="rn", n=12).join(
        lead_within(df, ["k"], ["start", "tb"], "tb", "nxt", n=12).select("tb", "nxt"), "tb"
    )
    assert got.select("tb", "rn", "nxt").exceptAll(exp).count() == 0 and got.count() == 20_000


def test_slices_are_balanced_and_the_same_every_time(spark):
    df = spark.range(0, 300, 1, 3).select(F.explode(F.sequence(F.lit(0), F.lit(199))).alias("x"), "id")  # 60,000 rows
    bounds = slice_bounds(df, ["x", "id"], 20)
    assert bounds == slice_bounds(df.repartition(5), ["x", "id"], 20) and 15 <= len(bounds) <= 19
    sizes = [r["count"] for r in df.groupBy(slice_of(df, ["x", "id"], bounds).alias("s")).count().collect()]
    assert len(sizes) == len(bounds) + 1 and max(sizes) < 3 * 60_000 / 20
    plan = row_number_within(df, ["x"], ["id"], n=20)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_numbering_without_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "v int")
    assert sorted((r.v or 0, r.rn) for r in row_number_within(df, [], ["v"], "rn", n=3).collect()) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    empty = df.limit(0).withColumn("k", F.lit(1))
    assert row_number_within(empty, ["k"], ["v"]).count() == 0 and lead_within(empty, ["k"], ["v"], "v", "n").count() == 0
    assert dense_rank_global(empty, "v").count() == 0


def test_descending_numbers_and_caps_match_window(spark):
    df = _skewed(spark).withColumn("start", F.when(F.col("tb") % 9 != 0, F.col("start")))
    w = Window.partitionBy("k").orderBy(F.col("start").desc(), F.col("tb").desc())
    exp = df.withColumn("rn", F.row_number().over(w))
    got = row_number_within(df, ["k"], ["start", "tb"], out="rn", n=7, descending=True)
    assert sorted(got.select("tb", "rn").collect()) == sorted(exp.select("tb", "rn").collect())
    for cap in (1, 60, 1000):
        got = row_number_within(df, ["k"], ["start", "tb"], out="rn", n=7, descending=True, at_most=cap)
        assert sorted(got.select("tb", "rn").collect()) == sorted(exp.where(F.col("rn") <= cap).select("tb", "rn").collect())


def test_running_within_matches_window(spark):
    """One key holds two thirds of the rows, so it lies in most slices; also the whole table as one key."""
    df = _skewed(spark).withColumns({"m": F.when(F.col("tb") % 4 == 0, F.col("tb") - 200), "d": (F.col("start") / 7).cast("decimal(12,3)")})
    df = df.withColumn("k", F.when(F.col("k") != 5, F.col("k")))  # a NULL key too
    aggregates = {"s": ("sum", "m"), "n": ("count", "m"), "lo": ("min", "m"), "hi": ("max", "d"), "l": ("last", "m"), "sd": ("sum", "d")}
    fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    for keys in (["k"], []):
        w = Window.partitionBy(*keys).orderBy("start", "tb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        exp = df.select("tb", *[fn[f](c).over(w).alias(o) for o, (f, c) in aggregates.items()])
        got = running_within(df, keys, ["start", "tb"], aggregates, n=9).select("tb", *aggregates)
        assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


def test_no_task_of_a_running_aggregate_holds_a_key(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("tb"))
    bounds = slice_bounds(df, ["k", "tb"], 8)
    sizes = df.groupBy(slice_of(df, ["k", "tb"], bounds).alias("s")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 4000 / 8 * 2


def test_running_within_names_unknown_functions(spark):
    with pytest.raises(ValueError, match="avg"):
        running_within(spark.range(3), [], ["id"], {"x": ("avg", "id")})


def test_both_ways_to_find_a_slice_agree(spark):
    df = _skewed(spark)
    bounds = slice_bounds(df, ["k", "start", "tb"], 40)
    both = df.select(slice_of(df, ["k", "start", "tb"], bounds).alias("a"), slice_of(df, ["k", "start", "tb"], bounds, tree=0).alias("b"))
    assert both.where("a <> b").count() == 0 and both.select("a").distinct().count() == len(bounds) + 1


def test_empty_table(spark):
    df = _skewed(spark).where("k > 99")
    assert slice_bounds(df, ["k", "tb"], 5) == []
    assert running_within(df, ["k"], ["tb"], {"s": ("sum", "tb")}).count() == 0
    assert row_number_within(df, ["k"], ["tb"], at_most=2).count() == 0
