import pytest
from pyspark.sql import functions as F

from tableops.operators import quality
from tableops.operators.ranking import top_percent
from helpers import rows


def test_top_percent_strict_and_ties(spark):
    # 20 distinct values, ties on the top value: 10 % of 20 ranks -> ranks 1 only (rank < 2)
    data = [(i, float(100 - i)) for i in range(20)] + [(99, 100.0)]
    df = spark.createDataFrame(data, "id int, spend double")
    got = top_percent(df, "spend", 0.10)
    assert rows(got, "id", "rank", "max_rank") == [(0, 1, 20), (99, 1, 20)]


def test_top_percent_can_be_empty(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(50)], "id int, spend double")
    assert top_percent(df, "spend", 0.01).count() == 0  # 5 distinct values: rank < 0.05 never holds


def test_duplicate_rows_null_keys_group_together(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 2), (2, "b", 3), (None, None, 4), (None, None, 5), (None, "x", 6)],
        "k int, s string, id int",
    )
    got = quality.duplicate_rows(df, ["k", "s"])
    assert rows(got, "id", "dup_count") == [(1, 2), (2, 2), (4, 2), (5, 2)]


def test_batch_plan_sizes_and_reconcile(spark):
    data = [("a", i) for i in range(101)] + [("b", i) for i in range(100)] + [("c", 0)]
    df = spark.createDataFrame(data, "k string, id int")
    plan = quality.batch_plan(df, ["k"], 100, ["id"])
    counts = rows(quality.batch_counts(plan, ["k"]), "k", "batch", "n_rows")
    assert counts == [("a", 0, 100), ("a", 1, 1), ("b", 0, 100), ("c", 0, 1)]
    quality.reconcile_counts(plan, plan, ["k"])  # same -> no error
    with pytest.raises(ValueError):
        quality.reconcile_counts(plan, plan.where(F.col("id") != 5), ["k"])


def test_batch_plan_null_key_fails(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, id int")
    with pytest.raises(Exception, match="NULL value in key"):
        quality.batch_plan(df, ["k"], 100, ["id"]).collect()


def test_require_values(spark):
    df = spark.createDataFrame([("NMU",), ("Drop",)], "sheet string")
    quality.require_values(df, "sheet", ["NMU"])
    with pytest.raises(ValueError, match="Freeze"):
        quality.require_values(df, "sheet", ["NMU", "Freeze"])


def test_a_cap_that_would_drop_rows_is_reported(spark):
    df = spark.createDataFrame([(1, i) for i in range(9)] + [(2, 0)], "k int, v int")
    quality.require_at_most(df, ["k"], 9)
    with pytest.raises(ValueError, match="would drop 7 rows"):
        quality.require_at_most(df, ["k"], 2)


def test_bulk_load_refuses_a_cap_that_fires(spark):
    from tableops.plans.file_jobs import q_keyed_bulk_load

    with pytest.raises(ValueError, match="would drop"):
        q_keyed_bulk_load(spark, "/root/testdata/sf0.001", limit_per_center=3)
