"""Reading a table whose files were written with different schemas.

Spark reads a folder with one schema, and fails or gives nulls where an old file disagrees. Here files are grouped by
the schema in their footers (read by tasks, the file list being the input); the columns' types are joined in a lattice
in which no value is lost (integers widen to larger integers and decimals, decimals to wider ones, dates to timestamps,
any simple type to text); every group is read with its own schema, cast, and given what it lacks as nulls.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from .ranges import list_files, open_uri

INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Decimal digits that hold every value of an integer type.
DIGITS = dict(zip(INTEGERS, (3, 5, 10, 19)))


def join_types(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both exactly; None when there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    a, b = (T.DecimalType(DIGITS[x], 0) if x in INTEGERS and isinstance(y, T.DecimalType) else x for x, y in ((a, b), (b, a)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = scale + max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(precision, scale) if precision <= 38 else None
    floats = (T.FloatType(), T.DoubleType())
    if b in floats and a not in floats:
        a, b = b, a
    if a in floats and (b in floats or b in INTEGERS[:3]):
        return T.FloatType() if a == T.FloatType() and b in INTEGERS[:2] else T.DoubleType()
    if {a, b} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    simple = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)
    if T.StringType() in (a, b) and isinstance(a, simple) and isinstance(b, simple):
        return T.StringType()
    return None


def join_schemas(schemas: Mapping[str, T.StructType]) -> T.StructType:
    """The joined schema of named generations, columns in the order of their first appearance."""
    types: dict[str, T.DataType] = {}
    for name, schema in schemas.items():
        for f in schema:
            joined = join_types(types[f.name], f.dataType) if f.name in types else f.dataType
            if joined is None:
                first = next(n for n, s in schemas.items() if f.name in s.names)
                raise ValueError(
                    f"column {f.name!r} cannot be read as one type: {types[f.name].simpleString()} (since {first}) and "
                    f"{f.dataType.simpleString()} ({name})"
                )
            types[f.name] = joined
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def _schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path in batch.column("path").to_pylist():
            fs, where = open_uri(path)
            with fs.open_input_file(where) as opened:
                schema = from_arrow_schema(pq.read_schema(opened), prefer_timestamp_ntz=True)
            plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
            out.append((path, json.dumps(plain.jsonValue(), sort_keys=True)))
        paths, schemas = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(paths), pa.string()), pa.array(list(schemas), pa.string())], ["path", "schema"])


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``path, schema`` (JSON) of every Parquet file below ``path``, from its footer."""
    files = list_files(spark, path, glob="*.parquet").select("path")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return files.repartition(n, "path").mapInArrow(_schemas, "path string, schema string")


def read_generations(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path`` in one DataFrame, whatever schemas they were written with.

    A column whose types have no join fails with its name and the files that disagree. The driver holds the list of
    files, as it does for any scan; generations are few.
    """
    found = file_schemas(spark, path).groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    if not found:
        raise ValueError(f"no Parquet file below {path}")
    groups = sorted(((r["files"], T.StructType.fromJson(json.loads(r["schema"]))) for r in found), key=lambda g: g[0][0])
    target = join_schemas({files[0]: schema for files, schema in groups})
    parts = []
    for files, schema in groups:
        df = spark.read.schema(schema).parquet(*files)
        cast = [(F.col(f"`{f.name}`") if f.name in schema.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
        parts.append(df.select(*cast))
    return reduce(DataFrame.unionAll, parts)
