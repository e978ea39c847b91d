"""Property checks: slice-wise numbering equals the window functions on random inputs; upsert and update
invariants; pivot/unpivot round trip."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tableops.operators import reshape, upsert
from tableops.operators.ordered import dense_rank_global, lead_within, row_number_within

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

row = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5))
table = st.lists(row, min_size=1, max_size=60)


def _df(spark, data):
    # the third column makes the order total within a key
    return spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(data)], "k int, s int, i int")


@SETTINGS
@given(data=table, n=st.integers(1, 6))
def test_row_number_and_lead_equal_windows(spark, data, n):
    df = _df(spark, data)
    w = Window.partitionBy("k").orderBy("s", "i")
    exp = {r.i: (r.rn, r.nx) for r in df.select("i", F.row_number().over(w).alias("rn"), F.lead("s").over(w).alias("nx")).collect()}
    rn = {r.i: r.rn for r in row_number_within(df, ["k"], ["s", "i"], out="rn", n=n).collect()}
    nx = {r.i: r.nx for r in lead_within(df, ["k"], ["s", "i"], "s", "nx", n=n).collect()}
    assert {i: (rn[i], nx[i]) for i in rn} == exp


@SETTINGS
@given(data=table, n=st.integers(1, 6), desc=st.booleans())
def test_dense_rank_equals_window(spark, data, n, desc):
    df = _df(spark, data)
    order = F.col("k").desc() if desc else F.col("k").asc()
    exp = {r.i: r.r for r in df.select("i", F.dense_rank().over(Window.orderBy(order)).alias("r")).collect()}
    got = {r.i: r.r for r in dense_rank_global(df, "k", descending=desc, out="r", n=n).collect()}
    assert got == exp


keyed = st.lists(st.tuples(st.integers(0, 20), st.integers(-5, 5)), max_size=25, unique_by=lambda t: t[0])


@SETTINGS
@given(target=keyed, source=keyed)
def test_upsert_and_update_invariants(spark, target, source):
    t = spark.createDataFrame(target, "id int, v int")
    s = spark.createDataFrame(source, "id int, v int")
    up = upsert.upsert(t, s, ["id"])
    expected = {**dict(target), **dict(source)}
    assert {r.id: r.v for r in up.collect()} == expected
    assert sorted(map(tuple, upsert.upsert(up, s, ["id"]).collect())) == sorted(map(tuple, up.collect()))
    upd = upsert.update_from(t, s, ["id"], {"v": "v"})
    assert upd.count() == len(target)
    assert {r.id: r.v for r in upd.collect()} == {k: dict(source).get(k, v) for k, v in target}


@SETTINGS
@given(cells=st.dictionaries(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), st.integers(0, 9), min_size=1))
def test_pivot_then_unpivot_is_identity(spark, cells):
    df = spark.createDataFrame([(k, c, v) for (k, c), v in cells.items()], "k string, c string, v int")
    wide = reshape.pivot_sum(df, ["k"], "c", "v", ["x", "y", "z"])
    back = wide.unpivot(["k"], ["x", "y", "z"], "c", "v").where(F.col("v").isNotNull())
    assert {(r.k, r.c): r.v for r in back.collect()} == cells
