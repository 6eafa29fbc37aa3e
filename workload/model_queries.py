"""Every model, metric and lookup over the derived feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmart.operators import scd2
from gridmart.plans import intermediate, marts, metrics, semantic, serving, staging
from gridmart.plans.warehouse import MODELS
from gridmart.session import scratch_path

from . import domain
from .domain import warehouse
from .registry import add

# Decimal columns per model.
DOUBLES = {
    "stg_oltp__contracts": "monthly_amount",
    "stg_oltp__invoice_line_items": "unit_price amount tax_amount",
    "stg_oltp__invoices": "total_amount tax_amount",
    "stg_oltp__payments": "payment_amount",
    "stg_oltp__tariff_plans": "price_per_kwh monthly_base_fee",
    "stg_crm__campaigns": "budget actual_cost",
    "stg_crm__opportunities": "amount",
    "stg_iot__alert_events": "threshold_value actual_value",
    "stg_iot__energy_readings": "kwh_reading voltage current_amps",
    "stg_iot__temperature_readings": "temperature_celsius target_temperature",
    "stg_partner__grid_usage": "kwh_consumed kwh_produced peak_demand_kw",
    "stg_partner__product_catalog": "list_price",
    "int_billing__invoice_enriched": "unit_price amount tax_amount net_amount",
    "int_device__telemetry_daily": "total_kwh peak_kwh avg_temperature",
    "dim_contract": "monthly_amount",
    "fct_invoices": "unit_price amount tax_amount net_amount",
    "fct_payments": "payment_amount",
    "fct_contract_lifecycle": "monthly_amount",
    "fct_device_telemetry": "reading_value",
    "fct_energy_usage_daily": "total_kwh peak_kwh avg_temperature",
    "customer_360": "lifetime_invoice_total",
}

_GROUPS = {
    "stg_oltp__": "c1", "stg_crm__": "c2", "stg_iot__": "c4", "stg_partner__": "c5",
    "int_billing__invoice_enriched": "c7", "int_customer__unified_profile": "c8",
    "int_device__lifecycle": "c9", "int_device__telemetry_daily": "c10",
    "int_service__ticket_enriched": "c11", "dim_customer": "c12", "dim_contract": "c12",
    "dim_device": "c13", "dim_household": "c13", "dim_product": "c13", "dim_geography": "c15",
    "bridge_household_device": "c16", "fct_invoices": "c17", "fct_payments": "c18",
    "fct_contract_lifecycle": "c19", "fct_device_telemetry": "c20", "fct_energy_usage_daily": "c21",
    "fct_service_ticket_lifecycle": "c22", "bridge_service_ticket_customer": "c23", "customer_360": "c24",
}


def _inventory_id(model: str) -> str | None:
    if model.startswith("stg_crm__") and staging.SAAS_KEYS[model.removeprefix("stg_crm__")] is None:
        return "c3"
    if model == "stg_partner__product_catalog":
        return "c6"
    return next((i for prefix, i in _GROUPS.items() if model.startswith(prefix)), None)


# Marts over many shared models; those read more than once are stored instead of planned again and again.
WIDE = {"customer_360", "bridge_service_ticket_customer"}


def _model(name: str):
    def query(spark, sf):
        wh = warehouse(spark, sf, scratch_path(spark, "shared") if name in WIDE else None)
        wh.stored = wh.read_often(name) if name in WIDE else wh.stored
        return wh[name]

    return query


for _name in MODELS:
    _id = _inventory_id(_name)
    # Calendars come joined to the days and minutes of the data (c14 below), and snapshots
    # as their dimensions and as sn1.
    if _id:
        add(f"{_id}_{_name}", _model(_name), f"SELECT * FROM {_name}", DOUBLES.get(_name, ""))

add("c8_profile_with_crm_only", lambda s, d: intermediate.unified_profile(
        warehouse(s, d)["stg_oltp__customers"], warehouse(s, d)["stg_crm__contacts"],
        warehouse(s, d)["stg_crm__accounts"], keep_crm_only=True).select("customer_id", "crm_contact_id", "match_status"),
    """SELECT o.customer_id, c.contact_id AS crm_contact_id, CASE WHEN o.customer_id IS NULL THEN 'crm_only'
    WHEN c.contact_id IS NULL THEN 'oltp_only' ELSE 'matched' END AS match_status
FROM stg_oltp__customers o FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY lower(email) ORDER BY last_modified_date DESC NULLS LAST, created_date DESC NULLS LAST, contact_id DESC) AS rn
    FROM stg_crm__contacts) WHERE rn = 1) c ON lower(o.email) = lower(c.email)""")
add("c12_dim_contract_all_versions", lambda s, d: marts.dim_contract(scd2.scd2_from_log(
        domain.RawFeeds(s, d)["contracts"], "contract_id")).select("contract_sk", "contract_id", "status", "valid_from", "valid_to", "is_current"),
    """SELECT md5(concat_ws('-', CAST(contract_id AS VARCHAR), CAST(valid_from AS VARCHAR))) AS contract_sk, contract_id, status,
    valid_from, valid_to, valid_to IS NULL AS is_current FROM versions""")
add("c14_dim_date", lambda s, d: warehouse(s, d, first_day=None)["dim_date"],
    """SELECT * FROM dim_date WHERE full_date BETWEEN (SELECT date_trunc('year', first) FROM dated)
    AND (SELECT date_trunc('year', last) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM dated)
UNION ALL SELECT * FROM dim_date WHERE (SELECT first < DATE '1995-01-01' OR last > DATE '2024-12-31' FROM dated)""")
add("c14_dim_time", lambda s, d: warehouse(s, d)["dim_time"].join(
        domain.table(s, d, "events").groupBy((F.hour("ts") * 100 + F.minute("ts")).alias("time_key")).agg(
            F.count("*").alias("events")), "time_key", "left"),
    """SELECT t.*, e.events FROM dim_time t LEFT JOIN (
    SELECT hour(ts) * 100 + minute(ts) AS time_key, count(*) AS events FROM events GROUP BY 1) e USING (time_key)""")
add("c20_telemetry_counted_occurrences", lambda s, d: marts.fct_device_telemetry(
        *_telemetry_inputs(s, d), unique_events=False).select("telemetry_sk", "device_id", "event_timestamp", "event_type", "time_key"),
    "SELECT telemetry_sk, device_id, event_timestamp, event_type, time_key FROM fct_device_telemetry")
add("c20_telemetry_minute_of_day_keys", lambda s, d: marts.fct_device_telemetry(
        *_telemetry_inputs(s, d), time_of="minute").select("device_id", "event_timestamp", "event_type", "time_key"),
    """SELECT e.device_id, e.event_timestamp, e.event_type, t.time_key FROM all_events e
LEFT JOIN dim_time t ON hour(e.event_timestamp) * 60 + minute(e.event_timestamp) = t.time_key""")


def _telemetry_inputs(s, d):
    wh = warehouse(s, d)
    events = marts.all_events(*[wh[f"stg_iot__{m}"] for m in (
        "energy_readings", "temperature_readings", "device_status", "alert_events")])
    return events, wh["dim_device"], wh["dim_household"], wh["dim_date"], wh["dim_time"]


# --- metrics ----------------------------------------------------------------------------

def star(s, d):
    """The star's tables; a question builds those that it names."""
    return domain.Tables(
        domain.stored_marts(s, d), invoices="fct_invoices", payments="fct_payments", customers="dim_customer",
        contracts="dim_contract", products="dim_product", dates="dim_date")


def ask(measures, dimensions=(), filters=None, **rest):
    return lambda s, d: semantic.semantic_query(
        semantic.CONTRACT_REVENUE, star(s, d), measures, dimensions, filters, **rest)


MEAN = "CAST(sum(amount) AS DOUBLE) / count(amount) AS average_invoice_amount"

add("m1_semantic_query_two_facts", ask(
        ["revenue", "cash collected", "late payments"], ["customer segment", "yr"]),
    """SELECT coalesce(i.segment, p.segment) AS segment, coalesce(i.year, p.year) AS year, total_revenue, total_payments,
    late_payment_count
FROM (SELECT segment, year, sum(amount) AS total_revenue FROM invoice_star GROUP BY 1, 2) i
FULL JOIN (SELECT segment, year, sum(payment_amount) AS total_payments,
    count(*) FILTER (WHERE is_late_payment) AS late_payment_count FROM payment_star GROUP BY 1, 2) p
    ON i.segment IS NOT DISTINCT FROM p.segment AND i.year IS NOT DISTINCT FROM p.year""", "total_revenue total_payments")
add("m1_semantic_fact_sum", ask(["net revenue", "invoices.tax_amount"], ["revenue type", "invoice_status"]),
    """SELECT revenue_classification, invoice_status, sum(net_amount) AS net_amount, sum(tax_amount) AS tax_amount
FROM invoice_star GROUP BY 1, 2""", "net_amount tax_amount")
add("m2_total_revenue", ask(["total_revenue"], ["category", "year"]),
    "SELECT category, year, sum(amount) AS total_revenue FROM invoice_star GROUP BY 1, 2", "total_revenue")
add("m3_total_payments", ask(["total_payments"], ["payment_method", "region"]),
    "SELECT payment_method, region, sum(payment_amount) AS total_payments FROM payment_star GROUP BY 1, 2", "total_payments")
add("m4_invoice_count", ask(["invoice_count"], ["contract_type"]),
    "SELECT contract_type, count(invoice_line_sk) AS invoice_count FROM invoice_star GROUP BY 1")
add("m5_average_invoice_amount", ask(["average_invoice_amount"], ["segment"]),
    f"SELECT segment, {MEAN} FROM invoice_star GROUP BY 1")
add("m6_late_payment_count", ask(["late_payment_count"], ["quarter"]),
    "SELECT quarter, count(*) FILTER (WHERE is_late_payment) AS late_payment_count FROM payment_star GROUP BY 1")
add("m7_average_daily_energy", lambda s, d: metrics.average_daily_energy_consumption(warehouse(s, d)["fct_energy_usage_daily"])
    .select(F.round("average_daily_energy_consumption", 6).alias("average_daily_energy_consumption")),
    "SELECT round(CAST(sum(total_kwh) AS DOUBLE) / count(total_kwh), 6) AS average_daily_energy_consumption FROM fct_energy_usage_daily")


def operations(measure, dimensions, filters=None):
    def query(s, d):
        tables = domain.Tables(
            domain.stored_marts(s, d), usage="fct_energy_usage_daily", tickets="fct_service_ticket_lifecycle",
            profiles="customer_360", customers="dim_customer", dates="dim_date")
        found = semantic.semantic_query(semantic.OPERATIONS, tables, [measure], dimensions, filters)
        return found.withColumn(measure, F.round(measure, 6))

    return query


add("m7_daily_energy_by_region_and_month", operations("average_daily_energy_consumption", ["region", "month"]),
    """SELECT region, month_name, round(CAST(sum(total_kwh) AS DOUBLE) / count(total_kwh), 6) AS average_daily_energy_consumption
FROM fct_energy_usage_daily u LEFT JOIN dim_customer USING (customer_sk)
LEFT JOIN dim_date d ON u.date_key = d.date_key GROUP BY 1, 2""")
add("m8_first_response_by_priority", operations("average_first_response_time", ["priority"], {"year": lambda c: c >= 1997}),
    """SELECT priority, round(CAST(sum(time_to_first_response_hours) AS DOUBLE) / count(time_to_first_response_hours), 6)
    AS average_first_response_time
FROM fct_service_ticket_lifecycle JOIN dim_date ON opened_date_key = date_key WHERE year >= 1997 GROUP BY 1""")
add("m9_active_customers_by_segment", operations("active_customer_count", ["customer_segment"]),
    """SELECT segment AS customer_segment, count(*) FILTER (WHERE status = 'active') AS active_customer_count
FROM customer_360 GROUP BY 1""")
add("m10_uptime_by_region", operations("device_uptime_rate", ["customer_region"]),
    """SELECT region AS customer_region, round(CAST(sum(active_device_count) AS DOUBLE) / nullif(sum(total_device_count), 0), 6)
    AS device_uptime_rate FROM customer_360 GROUP BY 1""")
add("m8_first_response_time", lambda s, d: metrics.first_response_time(warehouse(s, d)["fct_service_ticket_lifecycle"]),
    """SELECT CAST(sum(time_to_first_response_hours) AS DOUBLE) / count(time_to_first_response_hours) AS average_first_response_time
FROM fct_service_ticket_lifecycle""")
add("m8_median_first_response_time", lambda s, d: metrics.median_first_response_time(warehouse(s, d)["fct_service_ticket_lifecycle"]),
    "SELECT median(time_to_first_response_hours) AS median_first_response_time FROM fct_service_ticket_lifecycle")
add("m9_active_customer_count", lambda s, d: metrics.active_customer_count(warehouse(s, d)["customer_360"]),
    "SELECT count(*) FILTER (WHERE status = 'active') AS active_customer_count FROM customer_360")
add("m10_device_uptime_rate", lambda s, d: metrics.device_uptime_rate(warehouse(s, d)["customer_360"]),
    "SELECT CAST(sum(active_device_count) AS DOUBLE) / sum(total_device_count) AS device_uptime_rate FROM customer_360")
add("m11_revenue_by_category", lambda s, d: semantic.revenue_by_category(star(s, d), 1997, 1),
    "SELECT category, sum(amount) AS total_revenue FROM invoice_star WHERE year = 1997 AND quarter = 1 GROUP BY 1", "total_revenue")
add("m11_top_customers", lambda s, d: semantic.top_customers(star(s, d), 1997),
    """SELECT customer_id, sum(amount) AS total_revenue FROM invoice_star WHERE year = 1997 GROUP BY 1
ORDER BY total_revenue DESC, customer_id LIMIT 10""", "total_revenue")
add("m11_late_payments_by_method", lambda s, d: semantic.late_payments_by_method(star(s, d), 1998, 1),
    """SELECT payment_method, count(*) FILTER (WHERE is_late_payment) AS late_payment_count
FROM payment_star WHERE year = 1998 AND quarter = 1 GROUP BY 1""")
add("m11_average_invoice", lambda s, d: semantic.average_invoice(star(s, d), "commercial_energy"),
    f"SELECT contract_type, {MEAN} FROM invoice_star WHERE contract_type = 'commercial_energy' GROUP BY 1")
add("m11_monthly_revenue_by_segment", lambda s, d: semantic.monthly_revenue_by_segment(star(s, d), 1996),
    "SELECT month_name, segment, sum(amount) AS total_revenue FROM invoice_star WHERE year = 1996 GROUP BY 1, 2", "total_revenue")
add("m12_recurring_revenue", lambda s, d: metrics.recurring_revenue(warehouse(s, d)["stg_oltp__contracts"]),
    """SELECT sum(monthly_amount) AS mrr, CAST(sum(monthly_amount) AS DOUBLE) / count(DISTINCT customer_id) AS arpu
FROM stg_oltp__contracts WHERE status = 'active'""", "mrr")
add("m12_churn_rate", lambda s, d: metrics.churn_rate(warehouse(s, d)["customer_360"]),
    "SELECT CAST(count(*) FILTER (WHERE status = 'churned') AS DOUBLE) / count(*) AS churn_rate FROM customer_360")
add("m12_payment_aging", lambda s, d: metrics.payment_aging(
        warehouse(s, d)["stg_oltp__invoices"], F.lit("2001-06-30").cast("date")),
    """SELECT CASE WHEN days <= 0 THEN 'not due' WHEN days <= 30 THEN '1-30 days' WHEN days <= 60 THEN '31-60 days'
    WHEN days <= 90 THEN '61-90 days' ELSE 'over 90 days' END AS aging_bucket, count(*) AS open_invoices,
    sum(total_amount) AS open_amount
FROM (SELECT *, date_diff('day', due_date, DATE '2001-06-30') AS days FROM stg_oltp__invoices WHERE status <> 'paid') GROUP BY 1""",
    "open_amount")
add("m12_alert_frequency", lambda s, d: metrics.alert_frequency(warehouse(s, d)["stg_iot__alert_events"]),
    """SELECT device_id, CAST(event_timestamp AS DATE) AS alert_date, count(*) AS alert_count
FROM stg_iot__alert_events GROUP BY 1, 2""")
add("m12_fleet_status", lambda s, d: metrics.fleet_status(warehouse(s, d)["int_device__lifecycle"]),
    "SELECT lifecycle_state, count(*) AS device_count FROM int_device__lifecycle GROUP BY 1")
add("m12_firmware_currency", lambda s, d: metrics.firmware_currency(warehouse(s, d)["int_device__lifecycle"]),
    """SELECT model, count(*) AS device_count, CAST(count(*) FILTER (WHERE v = newest) AS DOUBLE) / count(*) AS firmware_currency
FROM (SELECT model, v, max(v) OVER (PARTITION BY model) AS newest FROM (
    SELECT model, CAST(split_part(firmware_version, '.', 2) AS INTEGER) AS v FROM int_device__lifecycle)) GROUP BY 1""")
add("m12_service_levels", lambda s, d: metrics.service_levels(warehouse(s, d)["fct_service_ticket_lifecycle"]),
    """SELECT CAST(sum(time_to_resolve_hours) AS DOUBLE) / count(time_to_resolve_hours) AS mttr_hours,
    CAST(count(*) FILTER (WHERE ticket_status = 'escalated') AS DOUBLE) / count(*) AS escalation_rate,
    CAST(count(*) FILTER (WHERE time_to_resolve_hours <= 72) AS DOUBLE) / count(time_to_resolve_hours) AS sla_rate
FROM fct_service_ticket_lifecycle""")
add("j13_semantic_star_join", ask(
        ["invoice_count", "avg invoice"], ["product", "customers.country", "contracts.status"],
        {"pricing_tier": lambda c: c == "premium", "country": lambda c: c.isin("AS", "EU")}),
    f"""SELECT p.product_name, c.country, k.status, count(f.invoice_line_sk) AS invoice_count, {MEAN.replace('amount)', 'f.amount)')}
FROM fct_invoices f JOIN dim_customer c ON f.customer_sk = c.customer_sk AND c.country IN ('AS', 'EU')
JOIN dim_product p ON f.product_sk = p.product_sk AND p.pricing_tier = 'premium'
LEFT JOIN dim_contract k ON f.contract_sk = k.contract_sk GROUP BY 1, 2, 3""")

# --- lookups ----------------------------------------------------------------------------

add("v1_customer_search", lambda s, d: serving.customer_search(warehouse(s, d)["customer_360"], "household CUSTOMER#00000000"),
    """SELECT customer_id, email, first_name, last_name, segment, region, country, status, total_contracts, active_contracts,
    active_device_count, lifetime_invoice_total, total_service_tickets FROM customer_360
WHERE contains(lower(email), 'household customer#00000000')
    OR contains(lower(first_name || ' ' || last_name), 'household customer#00000000')
ORDER BY customer_id LIMIT 20""", "lifetime_invoice_total")
add("v2_customer_contracts", lambda s, d: serving.customer_contracts(marts.dim_contract(
        scd2.scd2_from_log(domain.RawFeeds(s, d)["contracts"], "contract_id")), "7"),
    """SELECT contract_id, contract_type, status, start_date, end_date, monthly_amount FROM versions
WHERE valid_to IS NULL AND customer_id = 7 ORDER BY start_date DESC, contract_id""", "monthly_amount")
add("v3_recent_invoices", lambda s, d: serving.recent_invoices(
        warehouse(s, d)["fct_invoices"], warehouse(s, d)["dim_customer"], "7"),
    """SELECT invoice_id, line_description, quantity, amount, tax_amount, net_amount, invoice_status, revenue_classification
FROM fct_invoices JOIN dim_customer USING (customer_sk) WHERE customer_id = 7 AND is_current
ORDER BY invoice_date_key DESC NULLS LAST, line_item_id LIMIT 25""", "amount tax_amount net_amount")
STATUS_AS_OF = "2024-01-30 23:30:00"
STATUS_SQL = f"""
SELECT device_id, event_type AS latest_event_type, event_timestamp AS latest_event_timestamp, _loaded_at AS latest_loaded_at,
    CASE WHEN minutes <= 15 THEN 'online' WHEN minutes <= 60 THEN 'stale' ELSE 'offline' END AS device_connectivity_status
FROM (SELECT *, date_diff('minute', event_timestamp, TIMESTAMP '{STATUS_AS_OF}') AS minutes, row_number() OVER (
    PARTITION BY device_id ORDER BY event_timestamp DESC, _loaded_at DESC, event_type DESC) AS rn FROM telemetry) WHERE rn = 1"""
add("v4_device_latest_status", lambda s, d: serving.device_latest_status(
        domain.RawFeeds(s, d)["telemetry_events"], F.lit(STATUS_AS_OF).cast("timestamp_ntz")).drop("latest_event_data"), STATUS_SQL)
