"""Readers, generators and sinks over feeds written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridmart.operators.scd2 import scd2_merge
from gridmart.plans import staging
from gridmart.plans.warehouse import Warehouse
from gridmart.session import scratch_path
from gridmart.sources import calendar, files, schemas, sinks

from . import domain
from .oracle import sk
from .registry import add

ARRAY_EVENTS = 2000
LOADED = "2024-02-01 00:00:00"


def loaded():
    return F.lit(LOADED).cast("timestamp_ntz")


def csv_feed(spark, sf, table):
    """The feed as CSV text: NULL as one of its markers, text quoted where needed."""
    path = scratch_path(spark, f"csv-{table}")
    names = StructType.fromDDL(schemas.file_columns(table)).names
    feed = domain.RawFeeds(spark, sf)[table]
    feed.select(*[F.col(c).cast("string") for c in names]).write.option("header", True).option(
        "nullValue", "\\N"
    ).csv(path)
    return path


def json_feed(spark, sf):
    """The telemetry feed as JSON lines."""
    path = scratch_path(spark, "json-lines")
    readings = domain.run_sql(spark, sf, domain.RAW_SQL["telemetry_readings"])
    domain.event_json(readings).select("event_json").write.text(path)
    return path


def s1(spark, sf):
    table = "invoice_line_items"
    return files.read_csv(spark, csv_feed(spark, sf, table), schemas.file_columns(table))


add("s1_typed_csv_scan", s1,
    "SELECT * EXCLUDE (_loaded_at) FROM raw_invoice_line_items", "unit_price amount tax_amount")


def s2(spark, sf):
    rows = files.read_csv(spark, csv_feed(spark, sf, "contacts"), schemas.file_columns("contacts"))
    return rows.groupBy("_is_deleted", "title").agg(
        F.count("*").alias("row_count"),
        F.count("last_modified_date").alias("modified"),
        F.count("department").alias("departments"),
        F.max("created_date").alias("newest"),
    )


add("s2_strict_load", s2, """
SELECT _is_deleted, title, count(*) AS row_count, count(last_modified_date) AS modified,
    count(department) AS departments, max(created_date) AS newest FROM raw_contacts GROUP BY 1, 2""")

FLAWED = "order_id bigint, amount decimal(12,2), status string"


def flawed_feed(spark, sf):
    """Orders as CSV lines; status P lacks a field, cheap ones have no number."""
    path = scratch_path(spark, "csv-flawed")
    amount = F.when(F.col("o_totalprice") < 100000, "n/a").otherwise(
        F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    )
    fields = [F.col("o_orderkey").cast("string").alias("order_id"), amount.alias("amount")]
    orders = domain.table(spark, sf, "orders")
    short, full = F.concat_ws(",", *fields), F.concat_ws(",", *fields, "o_orderstatus")
    lines = orders.select(F.when(F.col("o_orderstatus") == "P", short).otherwise(full).alias("value"))
    # The reader takes the first line of every file for its header; text files have none,
    # so each is given one by writing CSV with a single, unquoted column.
    lines.withColumnRenamed("value", "order_id,amount,status").write.option("header", True).option(
        "quote", ""
    ).option("sep", "|").csv(path)
    return path


add("s3_tolerant_load", lambda spark, sf: files.load_csv_tolerant(
        spark, flawed_feed(spark, sf), FLAWED, loaded()
    ).good.select("order_id", "amount", "status", "_loaded_at"),
    f"""SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
    o_orderstatus AS status, TIMESTAMP '{LOADED}' AS _loaded_at
FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice >= 100000""", "amount")


def s3_errors(spark, sf):
    load = files.load_csv_tolerant(spark, flawed_feed(spark, sf), FLAWED, loaded())
    return load.errors.groupBy("error_type", "error_message", "logged_at").agg(
        F.sum("record_count").alias("record_count")
    )


add("s3_load_error_log", s3_errors, f"""
SELECT CASE o_orderstatus WHEN 'P' THEN 'schema_mismatch' ELSE 'parse_error' END AS error_type,
    CASE o_orderstatus WHEN 'P' THEN 'field count differs from the header' ELSE 'not of its type: amount' END
        AS error_message, TIMESTAMP '{LOADED}' AS logged_at, count(*) AS record_count
FROM orders WHERE o_orderstatus = 'P' OR o_totalprice < 100000 GROUP BY 1, 2, 3""")

add("s3_quarantine", lambda spark, sf: files.load_csv_tolerant(
        spark, flawed_feed(spark, sf), FLAWED, loaded()
    ).quarantined.select("error_type", F.split("record", ",")[0].cast("bigint").alias("order_id")),
    """SELECT CASE o_orderstatus WHEN 'P' THEN 'schema_mismatch' ELSE 'parse_error' END AS error_type,
    CAST(o_orderkey AS BIGINT) AS order_id
FROM orders WHERE o_orderstatus = 'P' OR o_totalprice < 100000""")


def s4(spark, sf):
    """Numbers of each file run from 2 without a gap, in the order the rows were written."""
    path = scratch_path(spark, "csv-lineage")
    orders = domain.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    orders.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.option(
        "header", True
    ).csv(path)
    load = files.load_csv_tolerant(spark, path, "o_orderkey bigint, o_custkey bigint", loaded())
    number, key = F.col("_source_file_row_number"), F.col("o_orderkey")
    per_file = load.good.groupBy("_source_file_name").agg(
        F.count("*").alias("n"), F.count_distinct(number).alias("d"), F.min(number).alias("low"),
        F.max(number).alias("high"), F.max_by(key, number).alias("last"), F.max(key).alias("top"),
        F.min_by(key, number).alias("first"), F.min(key).alias("bottom"),
    )
    sound = (
        (F.col("low") == 2) & (F.col("high") == F.col("n") + 1) & (F.col("d") == F.col("n"))
        & (F.col("last") == F.col("top")) & (F.col("first") == F.col("bottom"))
    )
    return per_file.agg(F.sum("n").alias("row_count"), F.bool_and(sound).alias("numbered_without_gaps"))


add("s4_file_lineage", s4,
    "SELECT count(*) AS row_count, TRUE AS numbered_without_gaps FROM orders")


def s5(spark, sf):
    path = scratch_path(spark, "json-arrays")
    readings = domain.run_sql(spark, sf, domain.RAW_SQL["telemetry_readings"])
    # Arrays of consecutive events, so that one holds at most ARRAY_EVENTS at any volume.
    events = domain.event_json(readings)
    arrays = events.groupBy(F.floor(F.col("event_id") / ARRAY_EVENTS).alias("part")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("event_json"), ","), F.lit("]")).alias("value")
    )
    arrays.select("value").write.text(path)
    rows = files.read_json_array_lines(spark, path)
    return rows.select(
        F.try_variant_get("event_data", "$.device_id", "string").alias("device_id"),
        F.try_variant_get("event_data", "$.event_type", "string").alias("event_type"),
        F.try_variant_get("event_data", "$.event_timestamp", "timestamp_ntz").alias("event_timestamp"),
    )


add("s5_json_array_scan", s5,
    "SELECT device_id, event_type, event_timestamp FROM raw_telemetry_readings")

add("s6_envelope_extraction", lambda spark, sf: files.telemetry_envelope(
        files.read_json_lines(spark, json_feed(spark, sf)), loaded()).drop("event_data"),
    f"""SELECT device_id, event_type, event_timestamp, TIMESTAMP '{LOADED}' AS _loaded_at,
    DATE '{LOADED[:10]}' AS _ingestion_date FROM raw_telemetry_readings""")

add("s7_inline_json_parse", lambda spark, sf: files.parse_events(domain.table(spark, sf, "events"), "props")
    .groupBy(F.try_variant_get("event_data", "$.k", "int").alias("k")).agg(F.count("*").alias("row_count")),
    "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS row_count FROM events GROUP BY 1")

add("s8_parquet_scan", lambda spark, sf: files.read_parquet(spark, f"{sf}/lineitem.parquet")
    .filter("l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"),
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity >= 45")

add("s9_ingestion_stamps", lambda spark, sf: files.with_load_stamps(
        domain.table(spark, sf, "events").select("event_id"), loaded()),
    f"SELECT event_id, TIMESTAMP '{LOADED}' AS _loaded_at, DATE '{LOADED[:10]}' AS _ingestion_date FROM events")


def s11(spark, sf):
    days = calendar.date_dimension(spark, domain.FIRST_DAY, domain.LAST_DAY)
    orders = domain.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(
        F.count("*").alias("orders")
    )
    return days.join(orders, "full_date", "left")


add("s11_date_dimension", s11, """
SELECT d.*, o.orders FROM dim_date d LEFT JOIN (
    SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS orders FROM orders GROUP BY 1) o USING (full_date)""")


def s12(spark, sf):
    minutes = calendar.time_dimension(spark)
    events = domain.table(spark, sf, "events").groupBy(
        (F.hour("ts") * 100 + F.minute("ts")).alias("time_key")
    ).agg(F.count("*").alias("events"))
    return minutes.join(events, "time_key", "left")


add("s12_time_dimension", s12, """
SELECT t.*, e.events FROM dim_time t LEFT JOIN (
    SELECT hour(ts) * 100 + minute(ts) AS time_key, count(*) AS events FROM events GROUP BY 1) e USING (time_key)""")


def s13(spark, sf):
    view = "invoices_by_status_view"
    sinks.create_view(staging.cdc_model(domain.RawFeeds(spark, sf)["invoices"], "invoices"), view)
    return spark.sql(f"SELECT status, count(*) AS invoices, sum(total_amount) AS total FROM {view} GROUP BY status")


add("s13_view_sink", s13,
    "SELECT status, count(*) AS invoices, sum(total_amount) AS total FROM stg_oltp__invoices GROUP BY 1", "total")


def s14(spark, sf):
    model = staging.cdc_model(domain.RawFeeds(spark, sf)["products"], "products")
    path = scratch_path(spark, "table")
    sinks.write_table(model, path)
    return sinks.write_table(model, path)


add("s14_table_sink", s14, "SELECT * FROM stg_oltp__products")

MIDDLE = "2024-01-15 00:00:00"


def s15(spark, sf):
    """Two runs over a growing feed leave every row once."""
    path = scratch_path(spark, "incremental")
    feed = domain.RawFeeds(spark, sf)["grid_usage_readings"]
    early = feed.filter(F.col("_loaded_at") <= F.lit(MIDDLE).cast("timestamp_ntz"))
    sinks.incremental_append(early, path, ["reading_id"])
    return sinks.incremental_append(feed, path, ["reading_id"]).select("reading_id", "kwh_consumed", "_loaded_at")


add("s15_incremental_append", s15,
    "SELECT reading_id, kwh_consumed, _loaded_at FROM raw_grid_usage_readings", "kwh_consumed")


def s16(spark, sf):
    root = scratch_path(spark, "snapshots")
    feeds = domain.RawFeeds(spark, sf)
    cutoff = F.lit(MIDDLE).cast("timestamp_ntz")
    early = {"customers": feeds["customers"].filter(F.col("_source_ts") <= cutoff)}
    Warehouse(spark, early, buckets=8).snapshot("snp_customers", root)
    stored = Warehouse(spark, feeds, buckets=8).snapshot("snp_customers", root)
    return stored.select("customer_id", "status", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def two_runs(early: str, late: str, key: str, columns: str) -> str:
    """Versions after a snapshot of ``early`` and one of ``late``."""
    picked = ", ".join(f"{{0}}.{c}" for c in columns.split())
    return f"""
SELECT {picked.format('o')}, o.updated_at AS dbt_updated_at, o.updated_at AS dbt_valid_from,
    CASE WHEN n.updated_at > o.updated_at THEN n.updated_at END AS dbt_valid_to
FROM ({early}) o LEFT JOIN ({late}) n ON o.{key} = n.{key}
UNION ALL
SELECT {picked.format('n')}, n.updated_at, n.updated_at, CAST(NULL AS TIMESTAMP)
FROM ({late}) n LEFT JOIN ({early}) o ON o.{key} = n.{key}
WHERE o.{key} IS NULL OR n.updated_at > o.updated_at"""


EARLY_CUSTOMERS = f"""
SELECT customer_id, status, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY _source_ts DESC, _loaded_at DESC, _connector_batch_id DESC) AS rn
    FROM raw_customers WHERE _op <> 'DELETE' AND _source_ts <= TIMESTAMP '{MIDDLE}') WHERE rn = 1"""
LATE_CUSTOMERS = "SELECT customer_id, status, updated_at FROM stg_oltp__customers"

add("s16_snapshot_sink", s16, two_runs(EARLY_CUSTOMERS, LATE_CUSTOMERS, "customer_id", "customer_id status"))


def s17(spark, sf):
    fact = domain.warehouse(spark, sf)["fct_energy_usage_daily"]
    table = sinks.write_clustered(fact, scratch_path(spark, "clustered"), "date_key")
    return table.filter("date_key BETWEEN 20240110 AND 20240120").select("device_id", "date_key", "reading_count")


add("s17_clustered_write", s17, """
SELECT device_id, date_key, reading_count FROM fct_energy_usage_daily WHERE date_key BETWEEN 20240110 AND 20240120""")


def s18(spark, sf):
    root = scratch_path(spark, "layers")
    path = sinks.layer_path(root, " marts ", "dim_product")
    sinks.write_table(domain.warehouse(spark, sf).mart("dim_product"), path)
    return files.read_parquet(spark, f"{root}/marts/dim_product").groupBy("category").agg(
        F.count("*").alias("products")
    )


add("s18_layer_naming", s18, "SELECT category, count(*) AS products FROM dim_product GROUP BY 1")


def sn1(spark, sf):
    log = domain.RawFeeds(spark, sf)["customers"]
    early = log.filter(F.col("_source_ts") <= F.lit(MIDDLE).cast("timestamp_ntz"))
    first = scd2_merge(None, staging.cdc_model(early, "customers"), "customer_id")
    second = scd2_merge(first, staging.cdc_model(log, "customers"), "customer_id")
    return second.select(
        "customer_id", "status", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"
    )


add("sn1_scd2_merge", sn1, f"""
SELECT *, {sk('customer_id', 'dbt_valid_from')} AS dbt_scd_id
FROM ({two_runs(EARLY_CUSTOMERS, LATE_CUSTOMERS, 'customer_id', 'customer_id status')})""")
