"""Every check on feeds with a seeded defect, so that none passes by being empty."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmart.operators import quality as Q
from gridmart.operators.scd2 import scd2_from_log
from gridmart.plans import checks
from gridmart.plans.contracts import MART_SCHEMAS
from gridmart.session import scratch_path

from . import domain
from .domain import AS_OF, warehouse
from .registry import add


def tab(s, d, name):
    return domain.table(s, d, name)


def raw(s, d, name):
    return domain.RawFeeds(s, d)[name]


# How far the versions before each one reach; an open one reaches for ever.
EARLIER_END = """
SELECT contract_id, valid_from, CASE WHEN isfinite(reach) THEN reach END AS earlier_valid_to
FROM (SELECT contract_id, valid_from, max(coalesce(valid_to, TIMESTAMP 'infinity')) OVER (
    PARTITION BY contract_id ORDER BY valid_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {0})
WHERE valid_from < reach"""

add("d1_not_null", lambda s, d: Q.not_null(raw(s, d, "cases"), "contact_id").select("case_id"),
    "SELECT case_id FROM raw_cases WHERE contact_id IS NULL")
add("d2_unique", lambda s, d: Q.unique(raw(s, d, "invoice_line_items"), "line_item_id"),
    "SELECT line_item_id, count(*) AS n_records FROM raw_invoice_line_items GROUP BY 1 HAVING count(*) > 1")
add("d2_unique_key_is_clean", lambda s, d: Q.unique(warehouse(s, d)["fct_invoices"], "invoice_line_sk"),
    "SELECT invoice_line_sk, count(*) AS n_records FROM fct_invoices GROUP BY 1 HAVING count(*) > 1")
add("d3_accepted_values", lambda s, d: Q.accepted_values(raw(s, d, "contracts"), "status", ["active", "renewed", "cancelled"]),
    """SELECT status, count(*) AS n_records FROM raw_contracts WHERE status NOT IN ('active', 'renewed', 'cancelled') GROUP BY 1""")
add("d4_relationships", lambda s, d: Q.relationships(
        raw(s, d, "invoice_line_items"), "invoice_id", warehouse(s, d)["stg_oltp__invoices"], "invoice_id"),
    """SELECT invoice_id AS orphan_key FROM raw_invoice_line_items l
WHERE NOT EXISTS (SELECT 1 FROM stg_oltp__invoices i WHERE i.invoice_id = l.invoice_id)""")
add("d5_referential_integrity", lambda s, d: Q.referential_integrity(
        raw(s, d, "case_comments"), "case_id", warehouse(s, d)["stg_crm__cases"], "case_id"),
    """SELECT case_id AS orphan_key FROM raw_case_comments WHERE case_id NOT IN (SELECT case_id FROM stg_crm__cases)""")
add("d6_surrogate_key_collision", lambda s, d: Q.surrogate_key_collision(
        tab(s, d, "lineitem").select(F.md5(F.col("l_orderkey").cast("string")).alias("line_sk"), "l_orderkey", "l_linenumber"),
        "line_sk", ["l_orderkey", "l_linenumber"]),
    """SELECT md5(CAST(l_orderkey AS VARCHAR)) AS surrogate_key, count(DISTINCT l_orderkey || '|' || l_linenumber) AS distinct_natural_keys
FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey || '|' || l_linenumber) > 1""")
add("d7_scd2_no_overlap", lambda s, d: Q.scd2_no_overlap(
        scd2_from_log(raw(s, d, "contracts"), "contract_id").select(
            "contract_id", "valid_from",
            F.when(F.col("valid_to").isNotNull(), F.col("valid_to") + F.expr("INTERVAL '30' DAY")).alias("valid_to")),
        "contract_id"),
    EARLIER_END.format("late_versions"))
add("d7_versions_are_clean", lambda s, d: Q.scd2_no_overlap(
        scd2_from_log(raw(s, d, "contracts"), "contract_id"), "contract_id"),
    EARLIER_END.format("versions"))

COUNT_DAY = "2024-01-20"


def d8(s, d):
    history = tab(s, d, "events").groupBy(
        F.concat_ws("/", "event_type", (F.col("user_id") % 10).cast("string")).alias("model_name"), F.to_date("ts").alias("measured_at")
    ).agg(F.count("*").alias("row_count"))
    return Q.volume_anomaly(history, F.lit(COUNT_DAY).cast("date")).withColumn("deviation_pct", F.round("deviation_pct", 9)).withColumn(
        "avg_row_count", F.round("avg_row_count", 9))


add("d8_volume_anomaly", d8, f"""
SELECT model_name, row_count AS latest_row_count, round(mean, 9) AS avg_row_count,
    round(abs(row_count / mean - 1), 9) AS deviation_pct
FROM (SELECT *, avg(row_count) OVER week AS mean, count(*) OVER week AS days
    FROM (SELECT event_type || '/' || (user_id % 10) AS model_name, CAST(ts AS DATE) AS day, count(*) AS row_count
        FROM events GROUP BY ALL)
    WINDOW week AS (PARTITION BY model_name ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
WHERE day = DATE '{COUNT_DAY}' AND days > 2 AND abs(row_count / mean - 1) > 0.30""")


def freshness_sql(source: str, feed: str, as_of: str, warn: int, error: int) -> str:
    return f"""SELECT '{source}' AS source, m AS max_loaded_at, date_diff('minute', m, TIMESTAMP '{as_of}') AS age_minutes,
    CASE WHEN date_diff('minute', m, TIMESTAMP '{as_of}') > {error} THEN 'error'
        WHEN date_diff('minute', m, TIMESTAMP '{as_of}') > {warn} THEN 'warn' ELSE 'pass' END AS state
FROM (SELECT max(_loaded_at) AS m FROM {feed})"""


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def d9(s, d):
    return (
        Q.freshness(raw(s, d, "customers"), "oltp", at(AS_OF))
        .unionByName(Q.freshness(raw(s, d, "contacts"), "crm", at("2001-08-03 01:00:00")))
        .unionByName(Q.freshness(raw(s, d, "telemetry_events"), "iot", at("2024-01-31 01:20:00")))
        .unionByName(Q.freshness(raw(s, d, "grid_usage_readings"), "partner_feeds", at(AS_OF)))
    )


add("d9_source_freshness", d9, " UNION ALL ".join([
    freshness_sql("oltp", "raw_customers", AS_OF, 30, 60),
    freshness_sql("crm", "raw_contacts", "2001-08-03 01:00:00", 90, 180),
    freshness_sql("iot", "telemetry", "2024-01-31 01:20:00", 10, 30),
    freshness_sql("partner_feeds", "raw_grid_usage_readings", AS_OF, 2160, 4320),
]))


def d10(s, d):
    broken = raw(s, d, "contracts").select(
        "contract_id",
        F.when(F.col("contract_type") == "device_subscription", "unknown").otherwise(F.col("status")).alias("status"),
        F.when(F.col("monthly_amount") > 100000, F.col("start_date")).alias("start_date"),
        F.when(F.col("monthly_amount") > 200000, F.col("end_date")).alias("end_date"),
        F.lit("1999-01-01").cast("timestamp_ntz").alias("created_at"), "updated_at",
    )
    return Q.contract_status_rules(broken)


BROKEN_CONTRACTS = """(SELECT contract_id, CASE WHEN contract_type = 'device_subscription' THEN 'unknown' ELSE status END AS status,
    CASE WHEN monthly_amount > 100000 THEN start_date END AS start_date,
    CASE WHEN monthly_amount > 200000 THEN end_date END AS end_date, TIMESTAMP '1999-01-01' AS created_at, updated_at
    FROM raw_contracts)"""
add("d10_contract_status_rules", d10, f"""
SELECT 'invalid_status' AS failure_reason, contract_id FROM {BROKEN_CONTRACTS}
WHERE status NOT IN ('active', 'renewed', 'cancelled', 'expired', 'suspended', 'service_agreement')
UNION ALL SELECT 'terminal_missing_end_date', contract_id FROM {BROKEN_CONTRACTS}
WHERE status IN ('cancelled', 'expired') AND end_date IS NULL
UNION ALL SELECT 'active_missing_start_date', contract_id FROM {BROKEN_CONTRACTS} WHERE status = 'active' AND start_date IS NULL
UNION ALL SELECT 'updated_before_created', contract_id FROM {BROKEN_CONTRACTS} WHERE updated_at < created_at""")


def d11(s, d):
    profile = warehouse(s, d)["int_customer__unified_profile"]
    broken = profile.select(
        "customer_id",
        F.when(F.col("segment") == "residential", F.lit("matched")).when(F.col("country") == "EU", "maybe").otherwise("oltp_only").alias("match_status"),
        "crm_contact_id",
    )
    return Q.entity_match_rules(broken)


BROKEN_PROFILE = """(SELECT customer_id, CASE WHEN segment = 'residential' THEN 'matched' WHEN country = 'EU' THEN 'maybe'
    ELSE 'oltp_only' END AS match_status, crm_contact_id FROM int_customer__unified_profile)"""
add("d11_entity_match_rules", d11, f"""
SELECT 'invalid_match_status' AS failure_reason, customer_id FROM {BROKEN_PROFILE}
WHERE match_status NOT IN ('matched', 'oltp_only', 'crm_only')
UNION ALL SELECT 'matched_without_crm_contact', customer_id FROM {BROKEN_PROFILE} WHERE match_status = 'matched' AND crm_contact_id IS NULL
UNION ALL SELECT 'oltp_only_has_crm_contact', customer_id FROM {BROKEN_PROFILE}
WHERE match_status = 'oltp_only' AND crm_contact_id IS NOT NULL""")


def d12(s, d):
    """Device-days of single events repeat, and their values break the other rules."""
    daily = tab(s, d, "events").select(
        F.col("user_id").cast("string").alias("device_id"), F.to_date("ts").alias("reading_date"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("total_kwh"), F.lit(50.0).alias("peak_kwh"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("avg_temperature"),
        F.get_json_object("props", "$.k").cast("int").alias("total_reading_count"),
    )
    return Q.daily_rollup_rules(daily)


BROKEN_DAYS = """(SELECT CAST(user_id AS VARCHAR) AS device_id, CAST(ts AS DATE) AS reading_date,
    CASE WHEN event_type <> 'view' THEN value END AS total_kwh, 50.0 AS peak_kwh,
    CASE WHEN event_type <> 'click' THEN value END AS avg_temperature,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS total_reading_count FROM events)"""
add("d12_daily_rollup_rules", d12, f"""
SELECT 'total_kwh_less_than_peak' AS failure_reason, device_id, reading_date FROM {BROKEN_DAYS} WHERE total_kwh < peak_kwh
UNION ALL SELECT 'zero_reading_count', device_id, reading_date FROM {BROKEN_DAYS} WHERE total_reading_count <= 0
UNION ALL SELECT 'duplicate_grain', device_id, reading_date FROM {BROKEN_DAYS} GROUP BY 2, 3 HAVING count(*) > 1
UNION ALL SELECT 'implausible_temperature', device_id, reading_date FROM {BROKEN_DAYS} WHERE avg_temperature < -50 OR avg_temperature > 80""")
add("u2_union_of_failures", lambda s, d: Q.contract_status_rules(raw(s, d, "contracts")).groupBy("failure_reason").agg(
        F.count("*").alias("failures")),
    """SELECT 'updated_before_created' AS failure_reason, count(*) AS failures FROM raw_contracts
WHERE updated_at < created_at GROUP BY 1 HAVING count(*) > 0""")


# Written out, so that a contract that lost or gained a column is noticed.
MART_COLUMNS = {
    "dim_customer": 16, "dim_household": 10, "dim_device": 12, "dim_product": 9, "dim_contract": 16, "dim_date": 13,
    "dim_time": 5, "dim_geography": 5, "bridge_household_device": 6, "fct_invoices": 17, "fct_payments": 11,
    "fct_contract_lifecycle": 17, "fct_device_telemetry": 9, "fct_energy_usage_daily": 11,
    "fct_service_ticket_lifecycle": 18, "bridge_service_ticket_customer": 5, "customer_360": 27,
}


def d13(s, d):
    """Rows of each mart that came through its contract, with the number of its columns."""
    wh, parts = domain.stored_marts(s, d), None
    for mart in MART_SCHEMAS:
        rows = wh.mart(mart)
        part = rows.agg(F.count("*").alias("row_count")).select(
            F.lit(mart).alias("mart"), "row_count", F.lit(len(rows.columns)).alias("column_count"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


add("d13_schema_contract", d13, " UNION ALL ".join(
    f"SELECT '{m}' AS mart, count(*) AS row_count, {n} AS column_count FROM {m}" for m, n in MART_COLUMNS.items()))


def check_suite(s, d):
    """Failing rows per mart and check; clean, but for facts whose household or contract is unknown."""
    found = checks.write_failing_rows(domain.stored_marts(s, d), scratch_path(s, "failing"))
    every = s.createDataFrame([(c.model, c.name) for c in checks.CHECKS], "model string, check string")
    counts = found.groupBy("model", "check").agg(F.count("*").alias("n"))
    return every.join(counts, ["model", "check"], "left").groupBy("model").agg(
        F.count("*").alias("checks"), F.coalesce(F.sum("n"), F.lit(0)).alias("failing"))


add("d_check_suite", check_suite, """
SELECT * FROM (VALUES ('dim_customer', 7, 0), ('dim_household', 6, 0), ('dim_device', 6, 0), ('dim_product', 5, 0),
    ('dim_contract', 7, 0), ('dim_date', 4, 0), ('dim_time', 2, 0), ('dim_geography', 2, 0), ('fct_invoices', 8, 0),
    ('fct_payments', 7, 0), ('fct_contract_lifecycle', 3, 0), ('fct_device_telemetry', 7, 0),
    ('fct_energy_usage_daily', 6, 0), ('fct_service_ticket_lifecycle', 4, 0), ('bridge_service_ticket_customer', 4, 0),
    ('customer_360', 4, 0)) t(model, checks, failing)""")


def d14(s, d):
    """Customers without their personal data: the tags say which columns to leave out."""
    profile = warehouse(s, d)["customer_360"]
    return profile.drop(*Q.pii_columns(profile))


add("d14_pii_columns", d14, "SELECT * EXCLUDE (email, first_name, last_name, phone, address) FROM customer_360",
    "lifetime_invoice_total")
