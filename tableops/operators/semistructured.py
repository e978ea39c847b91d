"""Semi-structured payloads: decoding event bodies, path extraction, lateral flatten, nested API documents.

Payloads are parsed once into a VARIANT column (``try_parse_json``: a malformed payload gives NULL and the row
is kept) and fields are read from it with ``try_variant_get``; query outputs carry JSON text, not VARIANT,
because VARIANT cannot be grouped, compared or made distinct.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decode_body(body, hex_text: bool = False) -> Column:
    """UTF-8 text of an event body given as binary, or as hex text when ``hex_text``."""
    b = _c(body)
    raw = F.unhex(b) if hex_text else b
    return F.decode(raw, "UTF-8")


def decode_events(df: DataFrame, body_col: str, hex_text: bool = False, out: str = "payload") -> DataFrame:
    """Add ``out`` (VARIANT, NULL when the body is not JSON) and ``<out>_text`` (the decoded text)."""
    text = decode_body(body_col, hex_text)
    return df.withColumn(f"{out}_text", text).withColumn(out, F.try_parse_json(F.col(f"{out}_text")))


def get_path(payload, path: str, type_: str = "string") -> Column:
    """Field at JSON ``path`` (``$.a.b`` or ``a.b``) cast to ``type_``; NULL when missing or not castable."""
    p = path if path.startswith("$") else "$." + path
    return F.try_variant_get(_c(payload), p, type_)


def extract(df: DataFrame, payload: str, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add one column per ``name: (path, type)`` read from the VARIANT column ``payload``."""
    return df.withColumns({name: get_path(payload, path, typ) for name, (path, typ) in spec.items()})


def flatten(
    df: DataFrame, col: str, outer: bool = False, index: str = "index", value: str = "value", key: str | None = None
) -> DataFrame:
    """Lateral flatten: one row per element of an array, or per field of an object.

    * array column: ``index`` (0-based) and ``value``;
    * map column: ``key`` and ``value``;
    * VARIANT column: a JSON array gives ``index``/``value``, a JSON object gives ``key``/``value`` (``index``
      NULL), each ``value`` a VARIANT; scalars give no rows.

    An empty or NULL input drops the row unless ``outer`` (then the new columns are NULL). ``key`` names the
    key column for maps and VARIANTs (default ``"key"``).

    The non-outer form is an outer generator followed by a filter on a generated field that is never NULL for a
    real element. A plain ``explode`` makes the optimizer infer ``size(col) > 0`` and push it below the
    projections, where it inlines the expression that builds ``col``: an array derived from a parsed payload
    would then be parsed once per reference in that filter, in the scan stage, instead of once.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.VariantType):
        # the built-in VARIANT generator, joined laterally (about 30 % faster than converting each value to an
        # array and to a map and exploding the union); it numbers object fields too, so the index is kept for
        # array elements only
        key = key or "key"
        tvf = df.sparkSession.tvf
        gen = (tvf.variant_explode_outer if outer else tvf.variant_explode)(F.col(col).outer()).alias("_ve")
        out = df.lateralJoin(gen)
        return out.select(
            *[df[c] for c in df.columns],
            F.when(F.col("_ve.key").isNull(), F.col("_ve.pos")).alias(index),
            F.col("_ve.key").alias(key),
            F.col("_ve.value").alias(value),
        )
    if isinstance(dtype, T.MapType):
        key = key or "key"
        out = df.select("*", F.explode_outer(F.col(col)).alias(key, value))
        return out if outer else out.where(F.col(key).isNotNull())
    out = df.select("*", F.posexplode_outer(F.col(col)).alias(index, value))
    return out if outer else out.where(F.col(index).isNotNull())


# --- nested API responses (weather forecast documents) ---------------------------------------------------

# Fixed value: field names of the public weather API's response.
FORECAST_SCHEMA = (
    "properties struct<timeseries: array<struct<time: string, data: struct<"
    "instant: struct<details: struct<air_temperature: double, cloud_area_fraction: double>>, "
    "next_1_hours: struct<details: struct<precipitation_amount: double>>>>>>"
)


def parse_forecast(df: DataFrame, json_col: str) -> DataFrame:
    """First time step of a forecast document: ``measure_time``, ``temperature``, ``cloud``, ``precipitation``."""
    doc = F.from_json(F.col(json_col), FORECAST_SCHEMA)
    first = F.element_at(doc.getField("properties").getField("timeseries"), 1)
    return df.withColumns(
        {
            "measure_time": first.getField("time"),
            "temperature": first["data"]["instant"]["details"]["air_temperature"],
            "cloud": first["data"]["instant"]["details"]["cloud_area_fraction"],
            "precipitation": first["data"]["next_1_hours"]["details"]["precipitation_amount"],
        }
    )
