"""Jobs that go through files: landing, loading, unloading, once-only ingestion.

Each job derives its input from the benchmark tables, writes it to a fresh folder below the shared
checkpoint directory (``spark.checkpoint.dir``), and reads it back through the ``sources`` readers, so the
whole file path of the reference -- landing zone, file selection, payload parsing, lineage, load -- runs on
data that grows with the tables. Writes are eager; the returned DataFrame reads the written files.
Paths cannot be reproduced by another engine, so lineage is returned as what must hold for it: that the row
numbers of each file run from 1 to its number of rows, and the load time.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code, date_path, last_path_part, parse_event_ts
from ..operators import quality, reshape, semistructured, upsert
from ..session import Tables, scratch_path
from ..sinks import (
    TEXT_TS_OPTIONS,
    clustered,
    load_append,
    merge_partitions,
    unload_partition,
    write_batches,
    write_date_folders,
    write_json_gzip,
    write_json_parts,
)
from ..sources import (
    ExtractLog,
    extract_new,
    incremental,
    next_watermark,
    read_capture,
    read_delimited,
    read_generations,
    read_json_array,
    read_json_payload,
    read_large_json_array,
    read_matching,
    sheet_layouts,
    typed_fields,
    with_lineage,
    write_capture,
)
from ..streaming import ingest_new_files, upsert_new_files
from .jobs import AS_OF, INCREMENTAL_PREV, MONEY, _event_bodies, forecast_long, forecast_sheet

LOADED_AT = dt.datetime(2001, 8, 2, 6, 0, 0)
FIRST_ROUND = dt.datetime(2024, 1, 22)

# Forecast record fields (all text in the landing JSON; value is numeric(15,5) in the table).
FORECAST_FIELDS = [
    "center_id", "center_name", "country_code", "business_unit", "unique_id", "currency", "currency_rate", "account",
    "club_oh", "forecast_file", "current_fc", "period", "metric_name", "extract_date",
]


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def lineage_checked(df: DataFrame) -> DataFrame:
    """The lineage columns replaced by ``lineage_ok`` (the numbers of the row's file are 1..n without gaps or
    repeats) and ``loaded_at``."""
    name, number, time = "etl_metadata_filename", "etl_metadata_file_row_number", "etl_created_timestamp_utc"
    n = F.count(F.lit(1))
    per_file = df.groupBy(name).agg(
        ((F.min(number) == 1) & (F.max(number) == n) & (F.count_distinct(number) == n)).alias("lineage_ok")
    )
    out = df.join(per_file, name).withColumn("loaded_at", F.col(time).cast("timestamp_ntz"))
    return out.drop(name, number, time)


# --- C2: forecast JSON lines -> typed table with payload and lineage --------------------------------------


def q_json_load(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    long = forecast_long(forecast_sheet(t), "Total price", "200008 forecast", AS_OF)
    landing = scratch_path(spark, "forecast-json")
    # one folder per (file, metric); the record keeps both fields, as the landing files do
    parts = {"file_part": F.col("forecast_file"), "metric_part": F.col("metric_name")}
    write_json_parts(long.withColumns(parts), landing, list(parts), cluster_by=["center_id"])

    raw = read_json_payload(spark, landing, regex=r".*\.json")
    spec = {c: (c, "string") for c in FORECAST_FIELDS}
    spec["value"] = ("value", "decimal(15,5)")
    typed = typed_fields(raw, "payload", spec).withColumn("payload_json", F.to_json("payload"))
    typed = with_lineage(typed, LOADED_AT)
    table = scratch_path(spark, "forecast-table")
    load_append(typed.drop("payload", "payload_text", "_metadata"), table)
    return lineage_checked(spark.read.parquet(table)).select(*FORECAST_FIELDS, "value", "lineage_ok", "loaded_at")


# --- R1 + C3: event-capture files, each loaded once, decoded into typed columns ---------------------------


def _decode_stream(df: DataFrame) -> DataFrame:
    dec = semistructured.decode_events(df, "Body", hex_text=True)
    f = semistructured.extract(
        dec, "payload", {"utc": ("UtcTime", "string"), "member_id": ("Member", "string"), "source": ("Source", "string"), "path": ("Path", "string")}
    )
    return f.select(
        "event_id",
        parse_event_ts("utc").alias("event_timestamp_utc"),
        "member_id",
        "source",
        last_path_part("path").alias("deviceid"),
        F.current_timestamp().alias("etl_created_timestamp_utc"),
    )


def q_event_ingest(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    capture = scratch_path(spark, "event-capture")
    bodies = _event_bodies(t)
    bodies = bodies.withColumns({"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts")}).drop("ts")
    days = ["y", "m", "d"]
    clustered(bodies, days, ["event_id"]).write.partitionBy(*days).json(capture)  # one folder per capture day

    sink, ckpt = scratch_path(spark, "event-table"), scratch_path(spark, "event-ckpt")
    ingest_new_files(spark, capture, "event_id bigint, Body string", sink, ckpt, transform=_decode_stream)
    again = ingest_new_files(spark, capture, "event_id bigint, Body string", sink, ckpt, transform=_decode_stream)
    if again:
        raise RuntimeError(f"second ingestion loaded {again} rows; files must load once")
    return spark.read.parquet(sink).drop("etl_created_timestamp_utc")


def q_event_capture(spark, sf_dir, range_bytes: int = 64 << 10) -> DataFrame:
    """Events landed as Avro capture files and read in runs of blocks; half of the files are compressed."""
    t = _t(spark, sf_dir)
    bodies = _event_bodies(t).select(
        F.col("event_id").alias("sequence_number"),
        (F.col("event_id") * 96).cast("string").alias("offset"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("enqueued_at"),
        F.unhex("Body").alias("body"),
    )
    capture = scratch_path(spark, "event-containers")
    write_capture(bodies.where("sequence_number % 2 = 0").repartition(2), f"{capture}/0", "deflate")
    write_capture(bodies.where("sequence_number % 2 = 1").repartition(2), f"{capture}/1", "null")
    events = semistructured.decode_events(read_capture(spark, capture, range_bytes), "body")
    fields = {"utc": ("UtcTime", "string"), "member_id": ("Member", "string"), "source": ("Source", "string"), "path": ("Path", "string")}
    return semistructured.extract(events, "payload", fields).select(
        F.col("sequence_number").alias("event_id"),
        "offset",
        F.col("enqueued_at").cast("timestamp_ntz").alias("enqueued_at"),
        parse_event_ts("utc").alias("event_timestamp_utc"),
        "member_id",
        "source",
        last_path_part("path").alias("deviceid"),
    )


# --- C5: scoring input unload (partition overwrite) and scoring output load ------------------------------


def scoring_results(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.unix_micros(F.to_date("o_orderdate").cast("timestamp")).alias("SCORING_DATE"),
        F.concat(F.lit("CU"), F.col("o_custkey").cast("string")).alias("PK"),
        ((F.col("o_orderkey") % 100000).cast("decimal(12,0)") / F.lit(100000)).cast("decimal(6,5)").alias("PREDICTION_PROBABILITY"),
        F.col("o_orderpriority").alias("MODEL_NAME"),
        F.col("o_orderstatus").alias("MODEL_VERSION"),
        F.col("o_orderdate").alias("SCORING_DATETIME_UTC"),
        F.year("o_orderdate").alias("scoring_year"),
    )


def q_unload_reload(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    stage = scratch_path(spark, "scoring")
    scores = scoring_results(t)
    unload_partition(scores, stage, ["scoring_year"], cluster_by=["PK"])
    # a rerun for one year replaces that partition only
    unload_partition(scores.where(F.col("scoring_year") == 2001).withColumn("MODEL_VERSION", F.lit("v2")), stage, ["scoring_year"])

    files = read_matching(spark, stage, "parquet", r".*\.parquet")
    loaded = with_lineage(files, LOADED_AT).select(
        F.to_date(F.timestamp_micros(F.col("SCORING_DATE"))).alias("scoring_date"),
        F.col("PK").cast("string").alias("pk"),
        F.col("PREDICTION_PROBABILITY").cast("decimal(6,5)").alias("prediction_probability"),
        F.col("MODEL_NAME").alias("model_name"),
        F.col("MODEL_VERSION").alias("model_version"),
        F.col("SCORING_DATETIME_UTC").cast("timestamp_ntz").alias("scoring_datetime_utc"),
        "etl_metadata_filename",
        "etl_metadata_file_row_number",
        "etl_created_timestamp_utc",
    )
    return lineage_checked(loaded)


# --- S5: semicolon files read by position (non-ASCII text, Latin-1 encoded) -------------------------------


def q_delimited_roundtrip(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "agreements")
    c = t.customer.select(
        F.col("c_nationkey").cast("string").alias("club"),
        F.col("c_custkey").cast("string").alias("member"),
        F.lit("1").alias("seq"),
        F.concat(F.lit("CU"), F.col("c_custkey").cast("string")).alias("member_code"),
        F.lit("unused").alias("x"),
        F.concat(F.col("c_mktsegment"), F.lit(" ÆØÅ")).alias("status"),
        F.date_add(F.lit(AS_OF), F.col("c_nationkey")).cast("string").alias("end_date"),
        F.col("c_acctbal").cast(MONEY).cast("string").alias("price"),
    )
    c.write.option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    schema = "c1 string, c2 string, c3 string, c4 string, c5 string, c6 string, c7 string, c8 string"
    rows = read_delimited(spark, path, schema, sep=";", encoding="ISO-8859-1")
    return rows.select(
        F.concat("c1", F.lit("p"), "c2", F.lit("rpt"), "c3").alias("agreement_code"),
        F.col("c4").alias("member_code"),
        F.col("c6").alias("person_status"),
        F.to_date("c7").alias("end_date"),
        F.col("c8").cast(MONEY).cast("double").alias("price"),
    )


# --- C1 complete: workbook sheets landed as files, selected, validated, unpivoted, written per metric -----

SHEETS = {"Total price": "sum", "Order count": "count"}
COUNTS_SKIP = 6  # the count sheet has no columns for the first months


def q_sheet_forecast(spark, sf_dir) -> DataFrame:
    """Two sheets whose month columns differ in order and in set, next to a workbook that is no forecast."""
    t = _t(spark, sf_dir)
    base = scratch_path(spark, "workbooks")
    for sheet, how in SHEETS.items():
        wide = forecast_sheet(t, how=how)
        if how == "count":
            months = reshape.columns_matching(wide, reshape.MONTH_COLUMN_REGEX)
            wide = wide.select(*months[:COUNTS_SKIP - 1:-1], *[F.col(f"`{c}`") for c in wide.columns if c not in months])
        wide.write.option("header", "true").csv(f"{base}/200008 forecast/{sheet}")
    notes = t.nation.select(F.col("n_name").alias("Country"), F.lit("7").alias("jan-90"))
    notes.write.option("header", "true").csv(f"{base}/000 notes/Total price")  # sorts first, other header

    layouts = sheet_layouts(spark, base, regex=r"\d{6}.*forecast")
    long = []
    for sheets in layouts:  # one per distinct header: every sheet is unpivoted by its own column names
        months = reshape.columns_matching(sheets, reshape.MONTH_COLUMN_REGEX)
        typed = sheets.withColumns({c: F.col(f"`{c}`").cast("double") for c in months}).withColumn("CC", F.col("CC").cast("long"))
        long.append(forecast_long(typed, F.col("sheet"), F.col("workbook"), AS_OF))
    facts = reduce(DataFrame.unionByName, long)
    found = reduce(DataFrame.unionByName, [sheets.select("sheet") for sheets in layouts])
    quality.require_values(found, "sheet", list(SHEETS))
    out = scratch_path(spark, "forecast-out")
    parts = {"file_part": F.col("forecast_file"), "metric_part": F.col("metric_name")}
    write_json_parts(facts.withColumns(parts), out, list(parts), cluster_by=["center_id"])
    return spark.read.schema(facts.schema).options(**TEXT_TS_OPTIONS).json(out).select(*facts.columns)


# --- C6: incremental extract to a gzip JSON-lines file --------------------------------------------------


def q_incremental_gzip(spark, sf_dir) -> DataFrame:
    """Two rounds: the first extracts what had arrived by ``FIRST_ROUND``, the second what came after the watermark
    that the first one stored."""
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "extract")
    columns = ["event_id", "ts", "user_id", "event_type"]
    schema = t.events.select(*columns).schema
    extracts, prev = [], INCREMENTAL_PREV
    arrived = t.events.where(F.col("ts") <= F.lit(FIRST_ROUND).cast("timestamp_ntz"))
    for k, table in enumerate((arrived, t.events), 1):
        write_json_gzip(incremental(table, "ts", prev).select(*columns), f"{path}/data-{k}")
        extract = spark.read.schema(schema).options(**TEXT_TS_OPTIONS).json(f"{path}/data-{k}")
        mark = f"{path}/watermark-{k}"
        next_watermark(extract, "ts", prev).write.options(**TEXT_TS_OPTIONS).json(mark)
        prev = spark.read.schema("watermark timestamp_ntz").options(**TEXT_TS_OPTIONS).json(mark).first()[0]
        extracts.append(extract.withColumn("round", F.lit(k)))
    return reduce(DataFrame.unionByName, extracts)


def q_tie_safe_extract(spark, sf_dir) -> DataFrame:
    """Three extracts of events whose times are cut to the hour. Half of an hour's rows arrive only after an extract has
    taken the others and made this hour its watermark; every row comes once."""
    t = _t(spark, sf_dir)
    events = t.events.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "user_id", "event_type")
    log = ExtractLog(spark, scratch_path(spark, "tie-safe"))
    for mark in (dt.datetime(2024, 1, 10, 7), dt.datetime(2024, 1, 20, 13), None):
        at = F.lit(mark).cast("timestamp_ntz")
        arrived = (F.col("hour") < at) | ((F.col("hour") == at) & (F.col("event_id") % 2 == 0))
        extract_new(events.where(arrived) if mark else events, log, "hour", ["event_id"])
    if extract_new(events, log, "hour", ["event_id"]) is not None:
        raise RuntimeError("an extract found rows though nothing has arrived")
    return log.read(events.schema)


def q_schema_generations(spark, sf_dir) -> DataFrame:
    """Orders in files of three schema generations, read in one call: the customer key widens from int to bigint to
    text, the price to a larger decimal, and a priority appears."""
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "generations")
    o, year = t.orders, F.year("o_orderdate")
    price = lambda kind: F.col("o_totalprice").cast(MONEY).cast(kind).alias("price")
    day = F.to_date("o_orderdate")
    first = o.where(year < 1996).select("o_orderkey", F.col("o_custkey").cast("int").alias("customer"), price("decimal(9,2)"), day.alias("day"))
    second = o.where(year.between(1996, 1998)).select(
        "o_orderkey", F.col("o_custkey").cast("bigint").alias("customer"), price("decimal(14,4)"), day.alias("day"), "o_orderpriority"
    )
    third = o.where(year > 1998).select(
        "o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("customer"), price("decimal(11,1)"), F.col("o_orderdate").alias("day"), "o_orderpriority"
    )
    for k, part in enumerate((first, second, third)):
        part.write.parquet(f"{path}/{k}")
    return read_generations(spark, path)


# --- C8: changed rows (flagged) merged field-wise into the document items ------------------------------

# Fixed value: fields of a stored item.
ITEM_SCHEMA = (
    "id bigint, centerId int, lifecycle_tag string, past_segment string, segment string, trend string, "
    "lifecycle_start_date string, segment_start_date string, changeddate string"
)
# The seven item fields a changed row overwrites (all others of the stored item survive).
PARTIAL_FIELDS = ["lifecycle_tag", "past_segment", "segment", "trend", "lifecycle_start_date", "segment_start_date", "changeddate"]


def segment_items(t: Tables) -> DataFrame:
    """Current document items: one per customer, with an extra field (``name``) the merge must not touch."""
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("centerId"),
        F.lit("active").alias("lifecycle_tag"),
        F.lit(None).cast("string").alias("past_segment"),
        F.col("c_mktsegment").alias("segment"),
        F.lit("flat").alias("trend"),
        F.lit("1995-01-01").alias("lifecycle_start_date"),
        F.lit("1995-01-01").alias("segment_start_date"),
        F.lit("1995-01-01").alias("changeddate"),
        F.col("c_name").alias("name"),
    )


def changed_view(t: Tables) -> DataFrame:
    """The warehouse view: JSON summaries with a To_be_Updated flag (negative balance -> changed; customers
    with a large balance also get a new item id, and those with a middling one moved to another centre: the same id
    under another partition key is another item)."""
    c = t.customer
    item = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("centerId"),
        F.lit("churn_risk").alias("lifecycle_tag"),
        F.col("c_mktsegment").alias("past_segment"),
        F.lower("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") < -500, F.lit("down")).otherwise(F.lit("stable")).alias("trend"),
        F.lit("2001-08-01").alias("lifecycle_start_date"),
        F.lit("2001-08-01").alias("segment_start_date"),
        F.lit("2001-08-01").alias("changeddate"),
    )
    new_item = item.withField("id", F.col("c_custkey") + 1_000_000)
    changed = c.select(F.to_json(item).alias("member_segment_summary"), (F.col("c_acctbal") < 0).cast("int").alias("To_be_Updated"))
    new = c.where(F.col("c_acctbal") > 9000).select(F.to_json(new_item).alias("member_segment_summary"), F.lit(1).alias("To_be_Updated"))
    moved = item.withField("centerId", (F.col("c_nationkey") + 1).cast("int"))
    moved = c.where(F.col("c_acctbal").between(5000, 6000)).select(F.to_json(moved).alias("member_segment_summary"), F.lit(1).alias("To_be_Updated"))
    return changed.unionByName(new).unionByName(moved)


# Fixed value: the store's key, partition key first.
ITEM_KEY = ["centerId", "id"]


def q_partial_changed(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    view = changed_view(t).where(F.col("To_be_Updated") == 1)
    parsed = view.select(F.from_json("member_segment_summary", ITEM_SCHEMA).alias("j")).select("j.*")
    return upsert.merge_partial(segment_items(t), parsed, ITEM_KEY, PARTIAL_FIELDS)


def q_partition_merge(spark, sf_dir) -> DataFrame:
    """Changed items of some centres merged into a store with a folder a centre: only these folders are written anew.
    ``file_kept`` tells the rows that still lie in a file of the store before the merge."""
    t = _t(spark, sf_dir)
    path = scratch_path(spark, "item-store")
    items = segment_items(t).drop("name")
    clustered(items, ["centerId"], ["id"]).write.partitionBy("centerId").parquet(path)
    kind = {"centerId": "int"}
    before = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct()
    listed = scratch_path(spark, "item-files")
    before.write.parquet(listed)

    view = changed_view(t).where(F.col("To_be_Updated") == 1)
    parsed = view.select(F.from_json("member_segment_summary", ITEM_SCHEMA).alias("j")).select("j.*")
    merge_partitions(spark, path, parsed.where(F.col("centerId") % 5 == 2), ITEM_KEY, ["centerId"])
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    old = spark.read.parquet(listed).withColumn("file_kept", F.lit(True))
    return rows.join(old, "file", "left").select(
        *[F.col(c).cast(kind[c]).alias(c) if c in kind else F.col(c) for c in items.columns],
        F.coalesce("file_kept", F.lit(False)).alias("file_kept"),
    )


def q_streaming_upsert(spark, sf_dir) -> DataFrame:
    """The latest event of every user, kept by a stream that merges landed files in several batches; files land out of
    order, so late events meet newer rows. A second run finds nothing to merge."""
    t = _t(spark, sf_dir)
    landing = scratch_path(spark, "user-events")
    rows = t.events.select(
        F.pmod("user_id", F.lit(16)).cast("int").alias("shard"), "user_id", "ts", "event_id", "event_type"
    )
    rows.repartition(6, F.xxhash64("event_id")).write.options(**TEXT_TS_OPTIONS).json(landing)
    schema = "shard int, user_id bigint, ts timestamp_ntz, event_id bigint, event_type string"
    target, checkpoint = scratch_path(spark, "user-state"), scratch_path(spark, "user-state-ckpt")
    key = {"keys": ["shard", "user_id"], "part_cols": ["shard"], "newest": ["ts", "event_id"]}
    for again in (False, True):
        n = upsert_new_files(spark, landing, schema, target, checkpoint, max_files_per_trigger=2, **key, **TEXT_TS_OPTIONS)
        if again and n:
            raise RuntimeError(f"second run merged {n} batches; files must be merged once")
    return spark.read.schema(schema).parquet(target).select(*rows.columns)


# --- C4 + C21: web-sale payloads, nested codes, payer search --------------------------------------------


def web_sales(t: Tables) -> DataFrame:
    """One sale message per order; ``Body`` is its JSON in hexadecimal, as captured. The message's field names are fixed
    values (see ``WEB_SALE_FIELDS``)."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    s = lambda c: F.col(c).cast("string")
    payer = F.when(
        F.col("o_orderstatus") == "F",
        F.struct(
            F.concat(F.lit("payer"), s("o_orderkey"), F.lit("@example.com")).alias("email"),
            F.struct(F.col("c_nationkey").alias("clubId"), (F.col("o_orderkey") % 50).alias("id")).alias("memberId"),
        ),
    )
    body = F.struct(
        F.struct(F.concat(F.lit("emp"), (F.col("o_orderkey") % 40).cast("string")).alias("externalId")).alias("salesPerson"),
        F.col("o_orderpriority").alias("saleType"),
        F.struct(
            F.struct(F.col("c_nationkey").alias("clubId"), F.col("c_custkey").alias("id")).alias("memberId"),
            s("c_custkey").alias("personId"),
        ).alias("member"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("R"), s("c_nationkey"))).alias("recruitmentCode"),
        F.struct(
            F.round("o_totalprice").cast("long").alias("periodPriceAmountInLocalCurrency"),
            F.struct(F.col("c_nationkey").alias("clubId"), F.col("o_orderkey").alias("id")).alias("subscriptionId"),
        ).alias("membership"),
        F.struct(F.struct(F.lit(1).alias("clubId"), (F.col("o_orderkey") % 50).alias("id")).alias("productId")).alias("selections"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("SUMMER")).alias("campaignCode"),
        F.col("c_mktsegment").alias("brand"),
        F.struct(F.concat(F.lit("N"), s("c_nationkey")).alias("country")).alias("club"),
        F.lit("web").alias("source"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdAt"),
        F.concat(F.lit("G"), s("o_orderkey")).alias("globalId"),
        F.struct(F.concat(F.lit("P"), s("o_orderkey")).alias("paymentReference")).alias("payment"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("V1")).alias("voucher"),
        F.col("c_nationkey").alias("clubSalesClubId"),
        payer.alias("otherPayer"),
    )
    text = F.to_json(body)
    return o.select("o_orderkey", text.alias("EVENT_PAYLOAD"), F.hex(F.encode(text, "UTF-8")).alias("Body"))


# The table's columns and where a sale message has them: a path, or the club path, infix and id path of a
# composite code.
WEB_SALE_FIELDS = {
    "salesperson_externalid": "salesPerson.externalId",
    "sale_type": "saleType",
    "contact_code": "member.personId",
    "member_code": ("member.memberId.clubId", "p", "member.memberId.id"),
    "recruitmentcode": "recruitmentCode",
    "subscription_id": ("membership.subscriptionId.clubId", "ss", "membership.subscriptionId.id"),
    "product_id": ("selections.productId.clubId", "prod", "selections.productId.id"),
    "campaign_code": "campaignCode",
    "brand": "brand",
    "country": "club.country",
    "source": "source",
    "createddate": "createdAt",
    "global_id": "globalId",
    "period_price": "membership.periodPriceAmountInLocalCurrency",
    "payment_reference": "payment.paymentReference",
    "voucher": "voucher",
    "clubsalesclubid": "clubSalesClubId",
}


def web_sale_columns(payload: str) -> dict:
    read = lambda path: semistructured.get_path(payload, path, "string")
    return {
        name: read(path) if isinstance(path, str) else code(read(path[0]), path[1], read(path[2]))
        for name, path in WEB_SALE_FIELDS.items()
    }


def _web_sale_table(spark, sf_dir) -> DataFrame:
    """Captured messages decoded, typed, given lineage and appended to a table, which is read back."""
    capture, table = scratch_path(spark, "sale-capture"), scratch_path(spark, "sale-table")
    web_sales(_t(spark, sf_dir)).select("o_orderkey", "Body").write.parquet(capture)
    raw = with_lineage(read_matching(spark, capture, "parquet", r".*\.parquet"), LOADED_AT)
    decoded = semistructured.decode_events(raw, "Body", hex_text=True)
    typed = decoded.withColumns(web_sale_columns("payload")).withColumn("event_payload", F.to_json("payload"))
    lineage = [c for c in raw.columns if c.startswith("etl_")]
    load_append(typed, table, ["o_orderkey", "event_payload", *WEB_SALE_FIELDS, *lineage])
    return spark.read.parquet(table)


def q_web_sale_load(spark, sf_dir) -> DataFrame:
    return lineage_checked(_web_sale_table(spark, sf_dir)).drop("event_payload")


def q_web_sale_search(spark, sf_dir) -> DataFrame:
    """Sales of a club's members paid by one other member: a path equality and an equality on the derived code."""
    p = _web_sale_table(spark, sf_dir).withColumn("v", F.try_parse_json("event_payload"))
    g = lambda path: semistructured.get_path("v", path, "string")
    found = p.select(
        "o_orderkey",
        g("otherPayer.email").alias("otherpayer_email"),
        g("otherPayer.memberId.clubId").alias("clubid"),
        g("otherPayer.memberId.id").alias("id"),
        code(g("otherPayer.memberId.clubId"), "p", g("otherPayer.memberId.id")).alias("otherpayer_membercode"),
        g("member.memberId.id").alias("m_id"),
        g("member.memberId.clubId").alias("c_id"),
    ).withColumn("membercode", code("c_id", "p", "m_id"))
    return found.where((F.col("c_id") == "7") & (F.col("otherpayer_membercode") == "7p32"))


def q_composite_codes(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    p = web_sales(t).withColumn("v", F.try_parse_json("EVENT_PAYLOAD"))
    g = lambda path: semistructured.get_path("v", path, "string")
    codes = p.select(
        "o_orderkey",
        g("member.personId").alias("contact_code"),
        code(g("member.memberId.clubId"), "p", g("member.memberId.id")).alias("member_code"),
        code(g("membership.subscriptionId.clubId"), "ss", g("membership.subscriptionId.id")).alias("subscription_id"),
        code(g("selections.productId.clubId"), "prod", g("selections.productId.id")).alias("product_id"),
        g("saleType").alias("sale_type"),
        g("otherPayer.email").alias("otherpayer_email"),
        g("member.memberId.clubId").alias("c_id"),
        code(g("otherPayer.memberId.clubId"), "p", g("otherPayer.memberId.id")).alias("otherpayer_membercode"),
    )
    # payer search: a filter on the derived alias
    return codes.where(F.col("otherpayer_membercode").isNotNull() & F.col("otherpayer_membercode").startswith(F.col("c_id")))


def q_variant_flatten(spark, sf_dir) -> DataFrame:
    """Lateral flatten of a VARIANT object: one row per top-level field of each web-sale payload."""
    t = _t(spark, sf_dir)
    p = web_sales(t).select("o_orderkey", F.try_parse_json("EVENT_PAYLOAD").alias("v"))
    flat = semistructured.flatten(p, "v", index="idx", key="field")
    kind = F.schema_of_variant("value")
    kind = F.when(kind.startswith("OBJECT"), F.lit("object")).when(kind.startswith("ARRAY"), F.lit("array")).otherwise(F.lit("scalar"))
    return flat.select("o_orderkey", F.col("idx").cast("int").alias("idx"), "field", kind.alias("value_kind"), F.to_json("value").alias("value"))


# --- C20: code lookup in an array column --------------------------------------------------------------


def q_array_code_lookup(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    c = t.customer.select(
        F.concat(F.lit("CU"), F.col("c_custkey").cast("string")).alias("nk_contact"),
        F.array(
            F.concat(F.col("c_nationkey").cast("string"), F.lit("p"), F.col("c_custkey").cast("string")),
            F.concat(F.lower("c_mktsegment"), F.col("c_custkey").cast("string")),
            F.concat(F.lit("old"), (F.col("c_custkey") % 7).cast("string")),
        ).alias("historic_member_code_list"),
    )
    flat = semistructured.flatten(c, "historic_member_code_list", index="idx", value="code")
    return flat.where(F.col("code").startswith("1p")).select("nk_contact", "idx", "code")


# --- C7: full keyed load into the document store in checked batches ----------------------------------

# Fixed value: store batch size (one call per batch, one partition key per batch).
BULK_SIZE = 100
DOC_SCHEMA = "id bigint, centerId int, segment string, lifecycle_tag string, changeddate string"


def segment_documents(t: Tables) -> DataFrame:
    """The view to load: one JSON summary per order, partitioned in the store by the customer's nation."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    doc = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").alias("centerId"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_orderstatus").alias("lifecycle_tag"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("changeddate"),
    )
    return o.select(F.to_json(doc).alias("member_segment_summary"), F.col("o_orderdate"))


def q_keyed_bulk_load(spark, sf_dir, limit_per_center: int | None = None) -> DataFrame:
    """Load all documents in checked batches. ``limit_per_center`` fails the job, before anything is written, when a
    centre has more rows: a load must not drop rows silently."""
    t = _t(spark, sf_dir)
    docs = segment_documents(t)
    parsed = docs.select(F.from_json("member_segment_summary", DOC_SCHEMA).alias("d")).select("d.*")
    if limit_per_center is not None:
        quality.require_at_most(parsed, ["centerId"], limit_per_center)
    plan_path = scratch_path(spark, "segment-plan")
    quality.batch_plan(parsed, ["centerId"], BULK_SIZE, ["id"]).write.parquet(plan_path)
    planned = spark.read.parquet(plan_path)

    # the store before the load: documents of orders placed before 1998 in an older state, some of them also under
    # the centre that the member has left
    before = docs.where(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"))
    store = before.select(F.from_json("member_segment_summary", DOC_SCHEMA).alias("d")).select("d.*")
    store = store.withColumn("lifecycle_tag", F.lit("stale"))
    left = store.where(F.col("id") % 7 == 0).withColumn("centerId", F.col("centerId") + 100)
    store = store.unionByName(left)

    loaded = upsert.upsert(store, planned.drop("batch"), ITEM_KEY)
    path = scratch_path(spark, "segment-store")
    loaded.write.parquet(path)
    written = spark.read.parquet(path)
    # every planned batch must be present in full in what was written
    landed = written.join(planned.select("id", "centerId", "batch"), ITEM_KEY)
    quality.reconcile_counts(planned, landed, ["centerId"])
    return written


def q_batch_commit(spark, sf_dir) -> DataFrame:
    """All documents in batches of one centre, each a call of the store; the load commits when the counts of all calls
    agree with the plan. A load that dies leaves nothing, so only the committed one is read."""
    t = _t(spark, sf_dir)
    docs = segment_documents(t).select(F.from_json("member_segment_summary", DOC_SCHEMA).alias("d")).select("d.*")
    plan = scratch_path(spark, "batch-plan")
    quality.batch_plan(docs, ["centerId"], BULK_SIZE, ["id"]).write.parquet(plan)
    path = scratch_path(spark, "batch-store")
    write_batches(spark.read.parquet(plan), path, ["centerId"], "first")
    return spark.read.parquet(path).drop("load")


# --- S4 S9 K9 C25: array files, date folders, insert-select ---------------------------------------------


def q_json_array_load(spark, sf_dir, file_rows: int = 1 << 17) -> DataFrame:
    """Gzip files holding one JSON array each (customers of a nation in groups), read element by element. A group is
    what a run of ``file_rows`` customers of the table holds of a nation: however keys and nations are spread, no file
    holds more, and there are as many files as nations for each run."""
    t = _t(spark, sf_dir)
    element = F.struct("c_custkey", "c_name", F.col("c_acctbal").cast(MONEY).cast("string").alias("balance"))
    # the ids count up from a multiple of 2 ** 33 in each task of the scan
    run = F.floor(F.monotonically_increasing_id() / file_rows)
    customers = t.customer.select("c_nationkey", run.alias("run"), element.alias("element"))
    groups = customers.groupBy("c_nationkey", "run").agg(F.to_json(F.collect_list("element")).alias("value"))
    path = scratch_path(spark, "array-files")
    groups.select("value").write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    rows = read_json_array(spark, path, "c_custkey bigint, c_name string, balance string")
    return rows.select("c_custkey", "c_name", F.col("balance").cast(MONEY).cast("double").alias("balance"))


def q_json_array_split(spark, sf_dir, file_rows: int = 50_000, range_bytes: int = 256 << 10) -> DataFrame:
    """Orders landed as large uncompressed array files, whose remarks hold brackets, quotes and backslashes, read in
    byte ranges. Files hold about ``file_rows`` orders each, so their number grows with the table."""
    t = _t(spark, sf_dir)
    n_files = t.orders.count() // file_rows + 1
    remark = F.concat(F.lit('{"a, [b]\\'), F.col("o_orderpriority"), F.lit('\\\\"}, {'))
    element = F.to_json(F.struct("o_orderkey", "o_custkey", remark.alias("remark")))
    file = F.pmod(F.xxhash64("o_orderkey"), F.lit(n_files)).cast("int")
    rows = t.orders.select(file.alias("file"), "o_orderkey", element.alias("value"))
    first = rows.groupBy("file").agg(F.min("o_orderkey").alias("first"))
    rows = rows.join(F.broadcast(first), "file")  # one row a file
    comma = F.when(F.col("o_orderkey") == F.col("first"), "[").otherwise(",")
    lines = rows.select("file", "o_orderkey", F.concat(comma, "value").alias("value"))
    ends = first.select("file", F.lit(None).cast("bigint").alias("o_orderkey"), F.lit("]").alias("value"))
    path = scratch_path(spark, "large-arrays")
    landed = lines.unionByName(ends).repartition(n_files, "file")
    landed = landed.sortWithinPartitions("file", F.col("o_orderkey").asc_nulls_last()).select("file", "value")
    landed.write.partitionBy("file").text(path)
    return read_large_json_array(spark, path, "o_orderkey bigint, o_custkey bigint, remark string", range_bytes)


def q_date_path_scan(spark, sf_dir, day: dt.date = dt.date(2024, 1, 11)) -> DataFrame:
    """All events landed in ``yyyy/MM/dd/`` folders by one write; the folder of one day is read."""
    t = _t(spark, sf_dir)
    base = scratch_path(spark, "event-days")
    events = t.events.withColumn("day", F.to_date("ts"))
    write_date_folders(clustered(events, ["day"], ["event_id"]), base, "day")
    folder = spark.range(1).select(date_path(F.lit(day))).first()[0]
    return read_matching(spark, f"{base}/{folder}", "parquet", r".*\.parquet").select("event_id", "ts", "user_id")


def q_insert_select(spark, sf_dir) -> DataFrame:
    """A table created from the early orders and extended by INSERT .. SELECT with the later ones; columns are matched
    by position."""
    t = _t(spark, sf_dir)
    path, name = scratch_path(spark, "orders-table"), f"tableops_orders_{uuid.uuid4().hex}"
    early = F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    columns = ["o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d")]
    t.orders.where(early).select(*columns).write.option("path", path).saveAsTable(name)
    try:
        load_append(t.orders.where(~early).select(*columns), name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay where they are
    return spark.read.parquet(path)
