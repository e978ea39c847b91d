import datetime as dt

from pyspark.sql import functions as F

from tableops.operators import audit
from helpers import rows

OBJ = "array<struct<objectName:string,objectDomain:string,columns:array<struct<columnName:string>>>>"
AS_OF = dt.date(2024, 1, 31)


def _access(spark):
    def o(name, dom="Table", cols=()):
        return (name, dom, [(c,) for c in cols])

    data = [
        ("q1", "SYS_BI", dt.datetime(2024, 1, 30, 10), [o("DB1.S1.D_A", cols=["NK", "X"]), o("DB1.S2.F_B", cols=["NK"])]),
        ("q2", "SYS_BI", dt.datetime(2024, 1, 30, 11), []),  # empty object array: dropped by the flatten
        ("q3", "SYS_BI", dt.datetime(2024, 1, 20, 9), [o("DB1.S1.D_A", cols=["NK"])]),  # outside 1-day look-back
        ("q4", "OTHER", dt.datetime(2024, 1, 30, 12), [o("DB1.S3.D_C", cols=["NK"])]),  # other user
        ("q5", "SYS_BI", dt.datetime(2024, 1, 30, 13), [o("DB1.S3.F_D", cols=["Y"]), o("DB1.S1.D_A", "View", ["NK"])]),
    ]
    return spark.createDataFrame(
        data, f"query_id string, user_name string, query_start_time timestamp_ntz, direct_objects_accessed {OBJ}"
    ).withColumn("base_objects_accessed", F.col("direct_objects_accessed"))


def _inventory(spark):
    ts = dt.datetime
    data = [
        ("DB1", "S1", "D_A", "BASE TABLE", 10, ts(2024, 1, 30, 1), ts(2020, 1, 1)),
        ("DB1", "S2", "D_A", "BASE TABLE", 11, ts(2024, 1, 1), ts(2020, 1, 1)),
        ("DB1", "S2", "F_B", "BASE TABLE", 12, None, ts(2024, 1, 30, 5)),
        ("DB1", "S3", "D_C", "BASE TABLE", 13, ts(2024, 1, 1), ts(2020, 1, 1)),
        ("DB1", "S3", "F_D", "BASE TABLE", 14, ts(2024, 1, 1), ts(2020, 1, 1)),
        ("DB1", "ST", "D_E", "BASE TABLE", 15, ts(2024, 1, 1), ts(2020, 1, 1)),
    ]
    return spark.createDataFrame(
        data,
        "table_catalog string, table_schema string, table_name string, table_type string, row_count long, "
        "last_altered timestamp_ntz, created timestamp_ntz",
    )


def test_table_usage(spark):
    got = audit.table_usage(_inventory(spark), _access(spark), AS_OF, ["SYS_BI"], pattern=r"DB1\.(S1|S2|S3)\.(D|F)_", pair=("S1", "S2"), when_queried="S3")
    assert rows(got, "fq_table_name", "updated_or_created_last_day", "queried_last_day", "table_exists_in_both") == [
        ("DB1.S1.D_A", "yes", "yes", "yes"),
        ("DB1.S2.D_A", "no", "no", "yes"),
        ("DB1.S2.F_B", "no", "yes", "no"),  # greatest(NULL, created) is NULL -> not 'yes'
        ("DB1.S3.F_D", "no", "yes", "no"),  # S3 kept only when queried; D_C was read by another user
    ]


def test_column_usage_one_row_per_column(spark):
    queries = spark.createDataFrame(
        [("q1", "SYS_BI", "select a", "SELECT", dt.datetime(2024, 1, 30)), ("q3", "SYS_BI", "select b", "SELECT", dt.datetime(2024, 1, 20)),
         ("q5", "SYS_BI", "insert c", "INSERT", dt.datetime(2024, 1, 30))],
        "query_id string, user_name string, query_text string, query_type string, end_time timestamp_ntz",
    )
    got = audit.column_usage(_access(spark), queries, "DB1.S1.D_A", AS_OF, 30, ["SYS_BI"])
    assert rows(got, "query_id") == [("q1",), ("q1",), ("q3",)]  # q5 read D_A as a View: not counted
    only_nk = audit.column_usage(_access(spark), queries, "DB1.S1.D_A", AS_OF, 1, ["SYS_BI"], columns=["NK"], query_type="SELECT")
    assert rows(only_nk, "query_id") == [("q1",)]


def test_query_search(spark):
    q = spark.createDataFrame(
        [("1", "ME", "select 1", "SELECT", dt.datetime(2024, 1, 1)), ("2", "ME", "select x", "SELECT", dt.datetime(2024, 1, 3)),
         ("3", "ME", "select y", "SELECT", dt.datetime(2024, 1, 2)), ("4", "YOU", "select z", "SELECT", dt.datetime(2024, 1, 4)),
         ("5", "ME", "insert", "INSERT", dt.datetime(2024, 1, 5))],
        "query_id string, user_name string, query_text string, query_type string, end_time timestamp_ntz",
    )
    got = audit.query_search(q, "ME", ["select 1", "SELECT 'keep alive'"])
    assert [r.query_id for r in got.collect()] == ["2", "3"]  # newest first


def test_freshness_excludes_views(spark):
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)), (dt.datetime(2024, 1, 3), None)], "c timestamp_ntz, u timestamp_ntz")
    b = spark.createDataFrame([(dt.datetime(2023, 5, 5),)], "c timestamp_ntz")
    meta = spark.createDataFrame([("a", "BASE TABLE", dt.datetime(2024, 2, 1)), ("b", "VIEW", dt.datetime(2024, 2, 1))],
                                 "table_name string, table_type string, last_altered timestamp_ntz")
    got = audit.freshness({"a": (a, ["c", "u"]), "b": (b, ["c"])}, meta)
    assert rows(got, "table_name", "column_name", "max_ts") == [
        ("a", "c", dt.datetime(2024, 1, 3)), ("a", "u", dt.datetime(2024, 1, 2))
    ]
