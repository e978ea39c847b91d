import pytest
from pyspark.sql import functions as F

from tableops.functions.casts import try_number
from tableops.operators import enrich, reshape, schema, semistructured
from tableops.plans.jobs import forecast_long
from helpers import rows
import datetime as dt


def _wide(spark):
    return spark.createDataFrame(
        [
            ("1", "Club A", "NATION_1", "BU", "kept", 1.0, None, 3.0, 4.0, 9.0),
            (None, "Club B", "NATION_2", "BU", "kept", 5.0, 6.0, None, 8.0, 9.0),
            ("3", "Club C", "XX", "BU", "dropped", 1.0, 1.0, 1.0, 1.0, 9.0),
        ],
        "CC string, Name string, Country string, `Business unit` string, Extra string,"
        " `mai-21` double, `okt-21` double, `des-21` double, `jan-21` double, `jan-2021` double",
    )


def test_select_by_and_unpivot_keep_nulls(spark):
    df = _wide(spark)
    sel = reshape.select_by(df, ["CC", "Name", "Missing"])
    assert sel.columns == ["CC", "Name", "mai-21", "okt-21", "des-21", "jan-21"]  # 'jan-2021' fails the full match
    long = reshape.unpivot_months(sel, ["CC", "Name"])
    assert long.count() == 12 and long.where(F.col("value").isNull()).count() == 2


def test_pivot_unpivot_roundtrip(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "k string, c string, v int")
    wide = reshape.pivot_sum(df, ["k"], "c", "v", ["x", "y", "z"])
    assert rows(wide) == [("a", 1, 2, None), ("b", 3, None, None)]
    back = wide.unpivot(["k"], ["x", "y", "z"], "c", "v").where(F.col("v").isNotNull())
    assert rows(back, "k", "c", "v") == rows(df, "k", "c", "v")


def test_forecast_long(spark):
    more = {c: F.lit("x") for c in ("UniqeID", "Currency", "Currency rate", "Account", "Club/OH")}
    wide = _wide(spark).withColumns({**more, "Current FC": F.lit("2021-07-01")})
    got = forecast_long(wide, "Total price", "f1", dt.date(2024, 1, 1))
    assert {(r.unique_id, r.club_oh, r.current_fc) for r in got.collect()} == {("x", "x", "2021-07")}
    assert set(r.country_code for r in got.collect()) == {"NATION_1", "NATION_2"}
    periods = sorted({r.period for r in got.collect()})
    assert periods == ["2021-01", "2021-05", "2021-10", "2021-12"]
    assert {r.metric_name for r in got.collect()} == {"total_price"}


def test_decode_events_and_paths(spark):
    bodies = [
        '{"UtcTime": "3/4/2021 1:02:03 PM", "Member": "m1", "Path": "/a/b/dev1"}',
        '{"UtcTime": "2021-03-04T05:06:07", "Member": "m2"}',
        '{"UtcTime": broken',
    ]
    df = spark.createDataFrame([(b.encode().hex().upper(),) for b in bodies], "Body string")
    dec = semistructured.decode_events(df, "Body", hex_text=True)
    out = semistructured.extract(dec, "payload", {"m": ("Member", "string"), "p": ("Path", "string")})
    got = out.select("m", "p", (F.col("payload").isNull()).alias("bad")).collect()
    assert [(r.m, r.p, r.bad) for r in got] == [("m1", "/a/b/dev1", False), ("m2", None, False), (None, None, True)]


def test_flatten_drops_empty_unless_outer(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, arr array<string>")
    assert rows(semistructured.flatten(df, "arr").select("id", "index", "value")) == [(1, 0, "a"), (1, 1, "b")]
    assert semistructured.flatten(df, "arr", outer=True).count() == 4
    nulls = spark.createDataFrame([(1, ["a", None])], "id int, arr array<string>")
    assert rows(semistructured.flatten(nulls, "arr").select("id", "index", "value")) == [(1, 0, "a"), (1, 1, None)]


def test_flatten_parses_a_derived_array_once(spark):
    # the array is built from a parsed payload; the drop of empty arrays must not copy that parse into a filter
    df = spark.createDataFrame([('{"k": 3}',), ('{"k": 4}',), ("bad",)], "props string")
    k = F.from_json("props", "k int").getField("k")
    derived = df.select(k.alias("k")).select(
        F.when(F.col("k").isNull() | (F.col("k") % 2 == 0), F.array()).otherwise(F.array(F.col("k"), F.col("k") + 1)).cast("array<int>").alias("arr")
    )
    flat = semistructured.flatten(derived, "arr")
    assert rows(flat.select("index", "value")) == [(0, 3), (1, 4)]
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_parse_forecast_and_weather_flags(spark):
    docs = [
        ("Oslo", '{"properties":{"timeseries":[{"time":"t1","data":{"instant":{"details":{"air_temperature":1.5,'
                 '"cloud_area_fraction":50}},"next_1_hours":{"details":{"precipitation_amount":0.1}}}}]}}'),
        ("Bergen", '{"properties":{"timeseries":[{"time":"t2","data":{"instant":{"details":{"air_temperature":2,'
                   '"cloud_area_fraction":50.5}}}}]}}'),
    ]
    df = semistructured.parse_forecast(spark.createDataFrame(docs, "city string, doc string"), "doc")
    got = {r.city: r for r in enrich.weather_flags(df).collect()}
    assert (got["Oslo"].clear_sky, got["Oslo"].precipitation_flag) == ("yes", "no")
    assert (got["Bergen"].clear_sky, got["Bergen"].precipitation_flag) == ("no", None)
    clubs = spark.createDataFrame([("c1", "Oslo"), ("c2", "Tromso")], "club string, city string")
    assert rows(enrich.enrich(clubs, df.select("city", "temperature"), "city")) == [("Oslo", "c1", 1.5)]


def test_try_number_equals_try_cast(spark):
    vals = ["1", " 2 ", "-3.5", "1e3", "abc", "", None, "99999999999999999999", ".5", "5.", "+7", "- 1", "1.5D", "2f", "1L"]
    vals += ["NaN", "nan", "Infinity", "-inf", "+Infinity", "infinit", "0x1p3", "0x10", "1e", "e5", "\t4\n", "1 2", "1_000", "\u0663"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ["int", "bigint", "double", "float", "decimal(15,5)"]:
        got = df.select("s", try_number("s", t).cast("string").alias("a"), F.col("s").try_cast(t).cast("string").alias("b")).collect()
        assert [r for r in got if r.a != r.b] == [], t


def test_evolve(spark):
    df = spark.createDataFrame([(1, "a", 2)], "id int, name string, n int")
    out = schema.evolve(df, add={"note": "string"}, rename={"name": "label"}, drop=["n"], cast={"id": "bigint"})
    assert out.dtypes == [("id", "bigint"), ("label", "string"), ("note", "string")]
    with pytest.raises(ValueError):
        schema.evolve(df, drop=["nope"])


def test_flatten_variant_arrays_and_objects(spark):
    df = spark.createDataFrame(
        [(1, '{"b": 1, "a": {"x": [1, 2]}}'), (2, '[10, "two"]'), (3, "7"), (4, None), (5, "[]")], "id int, s string"
    ).withColumn("v", F.try_parse_json("s"))
    flat = semistructured.flatten(df.select("id", "v"), "v")
    got = rows(flat.select("id", "index", "key", F.to_json("value").alias("j")))
    assert got == [(1, None, "a", '{"x":[1,2]}'), (1, None, "b", "1"), (2, 0, None, "10"), (2, 1, None, '"two"')]
    assert semistructured.flatten(df.select("id", "v"), "v", outer=True).count() == 7
    # input columns named like the generator's own outputs stay intact
    clash = df.select("id", "v", F.lit("k").alias("key"), F.lit(9).alias("pos"))
    got = rows(semistructured.flatten(clash, "v", key="field").where("id = 2").select("key", "pos", "index", "field"))
    assert got == [("k", 9, 0, None), ("k", 9, 1, None)]


def test_flatten_map(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2})], "id int, m map<string,int>")
    assert rows(semistructured.flatten(df, "m").select("id", "key", "value")) == [(1, "a", 1), (1, "b", 2)]


def test_money_sum_equals_decimal_sum(spark):
    from tableops.plans.jobs import MONEY, money_sum

    vals = [0.285, 0.125, -0.005, 1e-3, 123456.785, 99999999999.99, -42.42, None, 0.1, 0.2, 7.0]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, x double")
    got = df.groupBy("g").agg(money_sum("x").alias("a"), F.sum(F.col("x").cast(MONEY)).cast("double").alias("b"))
    assert all(r.a == r.b for r in got.collect())
    assert df.where("x IS NULL").agg(money_sum("x").alias("a")).first().a is None
