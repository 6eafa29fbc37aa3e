"""The raw feeds, derived from the driver's tables.

Each feed is one SELECT in the dialect Spark and DuckDB share, so both sides start from
the same rows. Everything after the raw feeds is written twice: as DataFrame code in
``gridmart`` and, independently, as SQL in ``oracle.py``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridmart.operators.scd2 import scd2_merge
from gridmart.plans import staging
from gridmart.plans.contracts import MART_SCHEMAS
from gridmart.plans.warehouse import STORED, Warehouse
from gridmart.session import scratch_path
from gridmart.sources.schemas import raw_tables

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIRST_DAY, LAST_DAY = "1995-01-01", "2024-12-31"
# Stand-in for the wall clock: a little after the last event of every scale factor.
AS_OF = "2024-02-01 00:00:00"
AS_OF_DATE = "2002-01-01"

_START = "CAST('1995-01-01 08:00:00' AS <TS>)"


def _cdc(op: str, ts: str, batch: str) -> str:
    return (
        f"{op} AS _op, {ts} AS _source_ts, {ts} + INTERVAL 15 MINUTE AS _loaded_at, "
        f"{batch} AS _connector_batch_id"
    )


def _pad(column: str) -> str:
    return f"lpad(CAST({column} AS STRING), 12, '0')"


_PLACES = "JOIN {nation} ON {key} = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"


def _places(key: str) -> str:
    return _PLACES.replace("{key}", key)


_CUSTOMER_COLUMNS = """
    CAST(c_custkey AS BIGINT) AS customer_id,
    concat(c_name, '@Example.COM') AS email,
    c_mktsegment AS first_name,
    upper(c_name) AS last_name,
    concat('+45', {pad}) AS phone,
    concat('Road ', CAST(c_custkey AS STRING)) AS address,
    lpad(CAST(c_nationkey AS STRING), 4, '0') AS postal_code,
    n_name AS municipality,
    r_name AS region,
    substr(r_name, 1, 2) AS country,
    CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'residential' ELSE 'commercial' END AS segment
""".replace("{pad}", _pad("c_custkey"))

# Ids of things that share a number with a customer or supplier start elsewhere.
_HOME = "CAST(c_custkey + 500000000 AS BIGINT)"
_ORDER_HOME = "CAST(o_custkey + 500000000 AS BIGINT)"
_DEPOT = "CAST(s_suppkey + 900000000 AS BIGINT)"
_CONTRACT = "CAST(o_custkey + 300000000 AS BIGINT)"

_LINE_KEY = "CAST(l_orderkey * 10 + l_linenumber AS BIGINT)"
# Tells apart the changes of one line at one instant.
_LINE_BATCH = "concat(CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))"
_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"

RAW_SQL = {
    "customers": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")}, {_CUSTOMER_COLUMNS},
    CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status,
    {_START} AS created_at, {_START} AS updated_at
FROM {{customer}} {_places('c_nationkey')}
UNION ALL
SELECT {_cdc("CASE event_type WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END", "ts", _pad('event_id'))},
    {_CUSTOMER_COLUMNS},
    CASE event_type WHEN 'signup' THEN 'active' WHEN 'purchase' THEN 'active' WHEN 'error' THEN 'churned'
        WHEN 'view' THEN 'churned' ELSE 'inactive' END AS status,
    {_START} AS created_at, ts AS updated_at
FROM {{events}} JOIN {{customer}} ON user_id = c_custkey {_places('c_nationkey')}
""",
    "households": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")},
    {_HOME} AS household_id, CAST(c_custkey AS BIGINT) AS customer_id,
    concat('Road ', CAST(c_custkey AS STRING)) AS address,
    lpad(CAST(c_nationkey AS STRING), 4, '0') AS postal_code, n_name AS municipality,
    substr(r_name, 1, 2) AS country,
    CASE WHEN c_acctbal < 5000 THEN 'apartment' ELSE 'house' END AS household_type,
    {_START} AS created_at, {_START} AS updated_at
FROM {{customer}} {_places('c_nationkey')}
UNION ALL
SELECT {_cdc("'UPDATE'", _START, "'partner'")},
    {_DEPOT}, CAST(s_suppkey AS BIGINT),
    concat('Depot ', CAST(s_suppkey AS STRING)),
    concat('D', CAST(s_nationkey AS STRING)), n_name, substr(r_name, 1, 2), 'depot',
    {_START}, {_START}
FROM {{supplier}} {_places('s_nationkey')}
""",
    "installations": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")},
    CAST(s_suppkey AS BIGINT) AS installation_id, {_DEPOT} AS household_id,
    DATE '1995-02-01' AS installation_date, concat('P', CAST(s_nationkey AS STRING)) AS installer_partner_id,
    CASE WHEN s_acctbal < 0 THEN 'cancelled' ELSE 'completed' END AS status, s_name AS notes,
    {_START} AS created_at, {_START} AS updated_at
FROM {{supplier}}
""",
    "devices": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")},
    CAST(c_custkey AS BIGINT) AS device_id, concat('SN-', c_name) AS device_serial,
    {_HOME} AS household_id, lower(c_mktsegment) AS device_type,
    'maker' AS manufacturer, concat('Model ', CAST(c_nationkey AS STRING)) AS model,
    concat('1.', CAST(c_custkey % 12 AS STRING)) AS firmware_version,
    CASE WHEN c_acctbal < 8000 THEN DATE '1995-03-01' END AS installed_at,
    'inactive' AS status, {_START} AS created_at, {_START} AS updated_at
FROM {{customer}}
UNION ALL
SELECT {_cdc("'UPDATE'", "CAST('1996-01-01 08:00:00' AS <TS>)", "'activation'")},
    CAST(c_custkey AS BIGINT), concat('SN-', c_name), {_HOME}, lower(c_mktsegment),
    'maker', concat('Model ', CAST(c_nationkey AS STRING)), concat('1.', CAST(c_custkey % 12 AS STRING)),
    CASE WHEN c_acctbal < 8000 THEN DATE '1995-03-01' END,
    CASE WHEN c_acctbal < 0 THEN 'decommissioned' ELSE 'active' END, {_START},
    CAST('1996-01-01 08:00:00' AS <TS>)
FROM {{customer}} WHERE c_mktsegment <> 'FURNITURE'
""",
    "contracts": f"""
SELECT {_cdc("CASE WHEN o_orderstatus = 'P' THEN 'DELETE' WHEN o_orderstatus = 'O' THEN 'INSERT' ELSE 'UPDATE' END",
             "o_orderdate", _pad('o_orderkey'))},
    {_CONTRACT} AS contract_id, CAST(o_custkey AS BIGINT) AS customer_id,
    {_ORDER_HOME} AS household_id, CAST(o_orderkey % 200 AS BIGINT) AS product_id,
    CAST(o_custkey % 25 AS BIGINT) AS tariff_plan_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'commercial_energy' WHEN '2-HIGH' THEN 'device_subscription'
        ELSE 'residential_energy' END AS contract_type,
    CASE WHEN o_orderstatus = 'F' THEN 'active' WHEN o_orderpriority = '1-URGENT' THEN 'renewed'
        WHEN o_orderpriority = '2-HIGH' THEN 'cancelled' WHEN o_orderpriority = '3-MEDIUM' THEN 'expired'
        ELSE 'suspended' END AS status,
    CAST(o_orderdate AS DATE) AS start_date,
    CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate + INTERVAL 365 DAY AS DATE) END AS end_date,
    CAST(o_totalprice AS DECIMAL(12,2)) AS monthly_amount,
    {_START} AS created_at, o_orderdate AS updated_at
FROM {{orders}}
""",
    "tariff_plans": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")},
    CAST(n_nationkey AS BIGINT) AS tariff_plan_id, n_name AS plan_name,
    CASE WHEN n_regionkey < 2 THEN 'fixed' ELSE 'variable' END AS plan_type,
    CAST(n_regionkey AS DECIMAL(12,2)) AS price_per_kwh, CAST(n_nationkey AS DECIMAL(12,2)) AS monthly_base_fee,
    DATE '1995-01-01' AS valid_from, CASE WHEN n_regionkey < 2 THEN DATE '2001-12-31' END AS valid_to,
    {_START} AS created_at, {_START} AS updated_at
FROM {{nation}}
""",
    "products": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")},
    CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name,
    CASE WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'device' WHEN p_type = 'ECONOMY' THEN 'service'
        WHEN p_type = 'PROMO' THEN 'bundle' ELSE lower(p_type) END AS category,
    p_brand AS description, CASE WHEN p_retailprice < 910 THEN 'standard' ELSE 'premium' END AS pricing_tier,
    p_size < 40 AS is_active, {_START} AS created_at, {_START} AS updated_at
FROM {{part}}
""",
    "services": f"""
SELECT {_cdc("'INSERT'", _START, "'seed'")},
    CAST(p_partkey AS BIGINT) AS service_id, p_name AS service_name, lower(p_type) AS category,
    p_brand AS description, p_size < 25 AS is_active, {_START} AS created_at, {_START} AS updated_at
FROM {{part}}
""",
    "invoices": f"""
SELECT {_cdc("CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'DELETE' ELSE 'INSERT' END", "o_orderdate",
             _pad('o_orderkey'))},
    CAST(o_orderkey AS BIGINT) AS invoice_id, CAST(o_custkey AS BIGINT) AS customer_id,
    {_ORDER_HOME} AS household_id, {_CONTRACT} AS contract_id,
    CAST(o_orderdate AS DATE) AS invoice_date, CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due_date,
    CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, CAST(NULL AS DECIMAL(12,2)) AS tax_amount,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'issued' ELSE 'overdue' END AS status,
    o_orderdate AS created_at, o_orderdate AS updated_at
FROM {{orders}}
""",
    "invoice_line_items": f"""
SELECT {_cdc("CASE l_returnflag WHEN 'R' THEN 'DELETE' WHEN 'A' THEN 'UPDATE' ELSE 'INSERT' END", "l_shipdate",
             _LINE_BATCH)},
    {_LINE_KEY} AS line_item_id, CAST(l_orderkey AS BIGINT) AS invoice_id,
    CAST(l_partkey AS BIGINT) AS product_id, concat('Line ', CAST(l_linenumber AS STRING)) AS description,
    CAST(l_quantity AS BIGINT) AS quantity, {_PRICE} AS unit_price, {_PRICE} AS amount,
    CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(12,2)) END AS tax_amount,
    l_shipdate AS created_at, l_shipdate AS updated_at
FROM {{lineitem}}
""",
    "payments": f"""
SELECT {_cdc("CASE l_returnflag WHEN 'A' THEN 'DELETE' ELSE 'INSERT' END", "l_shipdate", _LINE_BATCH)},
    {_LINE_KEY} AS payment_id, CAST(l_orderkey AS BIGINT) AS invoice_id,
    CAST(o_custkey AS BIGINT) AS customer_id, CAST(l_shipdate AS DATE) AS payment_date,
    {_PRICE} AS payment_amount,
    CASE WHEN l_quantity < 15 THEN 'card' WHEN l_quantity < 30 THEN 'bank_transfer' ELSE 'direct_debit' END
        AS payment_method,
    CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'pending' END AS status,
    l_shipdate AS created_at, l_shipdate AS updated_at
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
""",
    "accounts": f"""
SELECT {_START} AS _loaded_at, {_pad('c_custkey')} AS _sync_id, c_acctbal < 0 AS _is_deleted,
    concat('ACC-', CAST(c_nationkey AS STRING)) AS account_id, concat(c_name, ' account') AS account_name,
    lower(c_mktsegment) AS industry, CAST(NULL AS STRING) AS website, CAST(NULL AS STRING) AS phone,
    concat('Road ', CAST(c_custkey AS STRING)) AS billing_address, n_name AS region,
    concat('USR-', CAST(n_regionkey AS STRING)) AS owner_id, DATE '1995-01-01' AS created_date,
    CASE WHEN c_acctbal < 9000 THEN DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) END AS last_modified_date
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
""",
    "contacts": f"""
SELECT o_orderdate + INTERVAL 1 DAY AS _loaded_at, {_pad('o_orderkey')} AS _sync_id,
    o_orderpriority <> '1-URGENT' AS _is_deleted,
    concat('CON-', CAST(o_custkey AS STRING), '-', o_orderstatus) AS contact_id,
    concat('ACC-', CAST(c_nationkey AS STRING)) AS account_id, lower(c_mktsegment) AS first_name,
    c_name AS last_name,
    concat(CASE WHEN o_custkey % 50 = 7 THEN 'FORMER ' ELSE '' END, upper(c_name), '@example.com') AS email, CAST(NULL AS STRING) AS phone,
    CASE o_orderstatus WHEN 'F' THEN 'Homeowner' ELSE 'Manager' END AS title,
    CASE o_orderstatus WHEN 'F' THEN NULL ELSE 'Facilities' END AS department,
    CAST(o_orderdate AS DATE) AS created_date,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS last_modified_date
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
""",
    "cases": f"""
SELECT o_orderdate + INTERVAL 1 DAY AS _loaded_at, {_pad('o_orderkey')} AS _sync_id,
    o_orderpriority = '5-LOW' AS _is_deleted, concat('CASE-', CAST(o_orderkey AS STRING)) AS case_id,
    concat('ACC-', CAST(c_nationkey AS STRING)) AS account_id,
    CASE WHEN o_totalprice > 20000 THEN concat('CON-', CAST(o_custkey AS STRING), '-', o_orderstatus) END AS contact_id,
    concat('Order ', CAST(o_orderkey AS STRING)) AS subject, c_name AS description,
    CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'escalated' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' ELSE 'medium' END AS priority,
    concat('sev', substr(o_orderpriority, 1, 1)) AS severity,
    CASE WHEN o_totalprice < 100000 THEN 'phone' ELSE 'email' END AS origin,
    CAST(o_orderdate AS DATE) AS created_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 5 DAY AS DATE)
         WHEN o_orderpriority = '2-HIGH' THEN CAST(o_orderdate + INTERVAL 2 DAY AS DATE) END AS closed_date,
    CAST(o_orderdate AS DATE) AS last_modified_date
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
""",
    "case_comments": f"""
SELECT l_shipdate AS _loaded_at, {_LINE_BATCH} AS _sync_id, l_returnflag = 'R' AS _is_deleted,
    concat('CMT-', CAST({_LINE_KEY} AS STRING)) AS comment_id,
    concat('CASE-', CAST(l_orderkey AS STRING)) AS case_id, concat('Item ', CAST(l_partkey AS STRING)) AS body,
    l_linestatus = 'O' AS is_public, concat('USR-', CAST(l_suppkey AS STRING)) AS created_by,
    CAST(l_shipdate AS DATE) AS created_date
FROM {{lineitem}}
""",
    "opportunities": f"""
SELECT o_orderdate AS _loaded_at, {_pad('o_orderkey')} AS _sync_id, o_orderstatus = 'P' AS _is_deleted,
    concat('OPP-', CAST(o_orderkey AS STRING)) AS opportunity_id,
    concat('ACC-', CAST(o_custkey % 25 AS STRING)) AS account_id, o_orderpriority AS name,
    CASE o_orderstatus WHEN 'F' THEN 'closed_won' ELSE 'proposal' END AS stage,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amount, CAST(o_orderdate AS DATE) AS close_date,
    CAST(o_orderkey % 101 AS BIGINT) AS probability, CAST(o_orderdate AS DATE) AS created_date,
    CAST(o_orderdate AS DATE) AS last_modified_date
FROM {{orders}}
""",
    "tasks": f"""
SELECT {_START} AS _loaded_at, {_pad('s_suppkey')} AS _sync_id, s_acctbal < 0 AS _is_deleted,
    concat('TSK-', CAST(s_suppkey AS STRING)) AS task_id, concat('ACC-', CAST(s_nationkey AS STRING)) AS account_id,
    CAST(NULL AS STRING) AS contact_id, s_name AS subject, 'open' AS status, 'high' AS priority,
    DATE '1995-04-01' AS due_date, CAST(NULL AS DATE) AS completed_date, DATE '1995-02-01' AS created_date
FROM {{supplier}}
""",
    "campaigns": f"""
SELECT {_START} AS _loaded_at, {_pad('n_nationkey')} AS _sync_id, n_regionkey = 4 AS _is_deleted,
    concat('CMP-', CAST(n_nationkey AS STRING)) AS campaign_id, n_name AS name, 'webinar' AS type,
    'active' AS status, DATE '1995-01-01' AS start_date, DATE '1995-12-31' AS end_date,
    CAST(n_nationkey * 1000 AS DECIMAL(12,2)) AS budget, CAST(n_nationkey * 500 AS DECIMAL(12,2)) AS actual_cost,
    DATE '1994-12-01' AS created_date
FROM {{nation}}
""",
    "campaign_members": f"""
SELECT {_START} AS _loaded_at, {_pad('c_custkey')} AS _sync_id, c_acctbal < 0 AS _is_deleted,
    concat('MBR-', CAST(c_custkey AS STRING)) AS member_id, concat('CMP-', CAST(c_nationkey AS STRING)) AS campaign_id,
    concat('CON-', CAST(c_custkey AS STRING), '-F') AS contact_id,
    CASE WHEN c_acctbal < 5000 THEN 'sent' ELSE 'responded' END AS status,
    CASE WHEN c_acctbal >= 5000 THEN DATE '1995-02-01' END AS first_responded_date,
    DATE '1995-01-02' AS created_date
FROM {{customer}}
""",
    "grid_usage_readings": """
SELECT concat('GR-', CAST(event_id AS STRING)) AS reading_id, concat('MTR-', CAST(user_id AS STRING)) AS meter_id,
    CAST(user_id AS BIGINT) AS household_id, CAST(ts AS DATE) AS reading_date,
    CAST(value AS DECIMAL(12,2)) AS kwh_consumed, CAST(0 AS DECIMAL(12,2)) AS kwh_produced,
    CAST(value AS DECIMAL(12,2)) AS peak_demand_kw, 'automatic' AS reading_source, ts AS _loaded_at,
    concat(event_type, '.csv') AS _source_file_name, CAST(event_id + 2 AS BIGINT) AS _source_file_row_number
FROM {events}
""",
    "installation_certifications": f"""
SELECT concat('CERT-', CAST(s_suppkey AS STRING)) AS certification_id, CAST(s_suppkey AS BIGINT) AS installation_id,
    concat('P', CAST(s_nationkey AS STRING)) AS installer_id, DATE '1995-02-02' AS certification_date,
    'electrical_safety' AS certification_type, DATE '1996-02-02' AS expiry_date, 'valid' AS status,
    s_name AS inspector_name, {_START} AS _loaded_at, 'certifications.csv' AS _source_file_name,
    CAST(s_suppkey + 2 AS BIGINT) AS _source_file_row_number
FROM {{supplier}}
""",
    "product_catalog_updates": f"""
SELECT CAST(l_partkey AS BIGINT) AS product_id, concat('Part ', CAST(l_partkey AS STRING)) AS product_name,
    lower(l_returnflag) AS category, concat('M', CAST(l_suppkey AS STRING)) AS manufacturer,
    CAST(l_linenumber AS STRING) AS model_number, l_linestatus AS specifications, {_PRICE} AS list_price,
    CAST(l_shipdate AS DATE) AS effective_date, l_returnflag = 'R' AS is_discontinued, l_shipdate AS _loaded_at,
    concat({_LINE_BATCH}, '.csv') AS _source_file_name, {_LINE_KEY} AS _source_file_row_number
FROM {{lineitem}}
""",
    # Purchases are delivered twice, an hour apart, with a corrected reading.
    "telemetry_readings": """
SELECT CAST(user_id AS STRING) AS device_id,
    CASE event_type WHEN 'purchase' THEN 'energy_reading' WHEN 'view' THEN 'temperature_reading'
        WHEN 'error' THEN 'alert_event' ELSE 'device_status' END AS event_type,
    ts AS event_timestamp, ts + INTERVAL 5 MINUTE AS _loaded_at, event_type AS cause,
    event_id, props, CAST(value AS DECIMAL(12,2)) AS reading
FROM {events}
UNION ALL
SELECT CAST(user_id AS STRING), 'energy_reading', ts, ts + INTERVAL 65 MINUTE, event_type, event_id, props,
    CAST(value AS DECIMAL(12,2)) + 1
FROM {events} WHERE event_type = 'purchase'
""",
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Shared-dialect SQL over the driver's tables."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql.replace("<TS>", "TIMESTAMP_NTZ"), **used)


def duckdb_sql(name: str) -> str:
    """The same feed for DuckDB, where the tables are views."""
    return re.sub(r"\{(\w+)\}", r"\1", RAW_SQL[name].replace("<TS>", "TIMESTAMP")).strip()


def event_json(readings: DataFrame) -> DataFrame:
    """``event_json``: one JSON text per event, shaped as the devices send it."""
    k = F.get_json_object("props", "$.k").cast("int")
    reading = F.col("reading")
    kind = F.col("event_type")
    cause = F.col("cause")
    payload = F.struct(
        F.when(kind == "energy_reading", reading).alias("kwh_reading"),
        F.when(kind == "energy_reading", (F.lit(230) + k / 10).cast("decimal(8,2)")).alias("voltage"),
        F.when(kind == "energy_reading", (k / 4).cast("decimal(8,2)")).alias("current"),
        F.when((kind == "device_status") & (cause == "click"), "online")
        .when((kind == "device_status") & (k < 50), "offline")
        .when(kind == "device_status", "degraded")
        .alias("status"),
        F.when((kind == "device_status") & (k >= 10), k).alias("battery_level"),
        F.when(kind == "device_status", -k).alias("signal_strength"),
        F.when(kind == "temperature_reading", reading).alias("temperature_celsius"),
        F.when(kind == "temperature_reading", k).alias("humidity_percent"),
        F.when(kind == "temperature_reading", F.lit(21.5)).alias("target_temperature"),
        F.when(kind == "alert_event", F.lit("threshold")).alias("alert_type"),
        F.when((kind == "alert_event") & (k >= 66), "critical")
        .when((kind == "alert_event") & (k >= 33), "warning")
        .when(kind == "alert_event", "info")
        .alias("severity"),
        F.when(kind == "alert_event", F.concat(F.lit("k="), k.cast("string"))).alias("message"),
        F.when(kind == "alert_event", k).alias("threshold_value"),
        F.when(kind == "alert_event", reading).alias("actual_value"),
    )
    event = F.struct(
        "device_id",
        "event_type",
        F.col("event_timestamp").cast("string").alias("event_timestamp"),
        payload.alias("payload"),
    )
    return readings.withColumn("event_json", F.to_json(event))


def telemetry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_json(run_sql(spark, sf_dir, RAW_SQL["telemetry_readings"]))
    return readings.select(
        F.parse_json("event_json").alias("event_data"),
        "device_id",
        "event_type",
        "event_timestamp",
        "_loaded_at",
        F.to_date("_loaded_at").alias("_ingestion_date"),
    )


class RawFeeds(dict):
    """Raw tables by name, derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name == "telemetry_events":
            df = telemetry_events(self.spark, self.sf_dir)
        elif name in raw_tables():
            df = run_sql(self.spark, self.sf_dir, RAW_SQL[name])
        else:
            raise KeyError(name)
        self[name] = df
        return df


# The first snapshot run saw the logs up to here, the second saw all of them.
FIRST_RUN = {"customers": "2024-01-15 00:00:00", "contracts": "1998-07-01 00:00:00"}


def two_runs(feeds: RawFeeds, table: str) -> DataFrame:
    """Versions of a change log after two snapshot runs."""
    log, key = feeds[table], staging.CDC_KEYS[table]
    early = log.filter(F.col("_source_ts") <= F.lit(FIRST_RUN[table]).cast("timestamp_ntz"))
    first = scd2_merge(None, staging.cdc_model(early, table), key)
    return scd2_merge(first, staging.cdc_model(log, table), key)


def warehouse(spark: SparkSession, sf_dir: str, store: str | None = None, **options) -> Warehouse:
    feeds = RawFeeds(spark, sf_dir)
    given = {
        "as_of": F.lit(AS_OF).cast("timestamp_ntz"),
        "first_day": FIRST_DAY,
        "last_day": LAST_DAY,
        "snapshots": {f"snp_{t}": partial(two_runs, feeds, t) for t in FIRST_RUN},
        "buckets": 8,  # a cluster keeps the default
    }
    return Warehouse(spark, feeds, store=store, **{**given, **options})


_MARTS: dict[tuple[str, str], Warehouse] = {}


# Staging that one mart alone reads is not written in between: the marts are.
READ_ONCE = {"stg_oltp__invoice_line_items", "stg_oltp__payments"}


class Tables(Mapping):
    """Tables of a metric model under its names, each taken from the warehouse when asked for."""

    def __init__(self, wh: Warehouse, **models: str):
        self.wh, self.models = wh, models

    def __getitem__(self, name: str) -> DataFrame:
        return self.wh[self.models[name]]

    def __iter__(self):
        return iter(self.models)

    def __len__(self) -> int:
        return len(self.models)


def stored_marts(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The marts as written tables, each when first asked for and once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MARTS:
        store = scratch_path(spark, "marts")
        _MARTS[key] = warehouse(spark, sf_dir, store, stored=(STORED - READ_ONCE) | set(MART_SCHEMAS))
    return _MARTS[key]
