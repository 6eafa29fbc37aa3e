"""The models once more, as DuckDB SQL over the driver's tables.

Written independently of ``gridmart``: only the raw feeds are shared. `query` puts the
definitions a SELECT needs in front of it as common table expressions.
"""

from __future__ import annotations

import re

from gridmart.plans.staging import CDC_KEYS, SAAS_KEYS

from . import domain
from .domain import AS_OF, AS_OF_DATE, FIRST_DAY, FIRST_RUN, LAST_DAY

NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = f"DATE '{AS_OF_DATE}'"


def sk(*parts: str) -> str:
    texts = ", ".join(
        f"coalesce(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts
    )
    return f"md5(concat_ws('-', {texts}))"


def star(source: str, dims: str, days: str) -> str:
    """``source`` with the surrogate keys of ``dims`` and a ``<day>_key`` per date column."""
    keys = "".join(f", {d}_sk" for d in dims.split()) + "".join(f", {d}_key" for d in days.split())
    joins = "".join(
        f" LEFT JOIN (SELECT {d}_id, {d}_sk FROM dim_{d}"
        + (" WHERE is_current" if d in ("customer", "contract") else "")
        + f") USING ({d}_id)"
        for d in dims.split()
    )
    joins += "".join(
        f" LEFT JOIN (SELECT full_date AS {d}_day, date_key AS {d}_key FROM dim_date) ON source.{d} = {d}_day"
        for d in days.split()
    )
    return f"SELECT source.*{keys} FROM {source} source{joins}"


def latest(source: str, keys: str, order: str, where: str = "TRUE") -> str:
    ordering = ", ".join(f"{c} DESC NULLS LAST" for c in order.split(", "))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordering}) AS rn "
        f"FROM {source} WHERE {where}) WHERE rn = 1"
    )


CDC_ORDER = "_source_ts, _loaded_at, _connector_batch_id"
SAAS_ORDER = "last_modified_date, _loaded_at, _sync_id"

MODELS: dict[str, str] = {f"raw_{name}": domain.duckdb_sql(name) for name in domain.RAW_SQL}



def current_rows(table: str, where: str = "TRUE") -> str:
    rows = latest(f"raw_{table}", CDC_KEYS[table], CDC_ORDER, f"_op <> 'DELETE' AND {where}")
    if table == "customers":
        return (
            "SELECT * EXCLUDE (_op) REPLACE (lower(email) AS email, "
            "upper(substr(first_name, 1, 1)) || lower(substr(first_name, 2)) AS first_name, "
            "upper(substr(last_name, 1, 1)) || lower(substr(last_name, 2)) AS last_name) "
            f"FROM ({rows})"
        )
    return f"SELECT * EXCLUDE (_op) FROM ({rows})"


for _table in CDC_KEYS:
    MODELS[f"stg_oltp__{_table}"] = current_rows(_table)

# Versions after a run over the early log and one over all of it: what both runs saw, each row with
# the time of the next one of its key.
for _table, _until in FIRST_RUN.items():
    _key = CDC_KEYS[_table]
    MODELS[f"snp_{_table}"] = f"""
SELECT * EXCLUDE (run), updated_at AS valid_from,
    lead(updated_at) OVER (PARTITION BY {_key} ORDER BY updated_at) AS valid_to
FROM (SELECT DISTINCT ON ({_key}, updated_at) * FROM (
    SELECT *, 1 AS run FROM ({current_rows(_table, f"_source_ts <= TIMESTAMP '{_until}'")})
    UNION ALL SELECT *, 2 FROM stg_oltp__{_table}) ORDER BY {_key}, updated_at, run)"""

for _table, _key in SAAS_KEYS.items():
    _rows = (
        latest(f"raw_{_table}", _key, SAAS_ORDER, "_is_deleted = FALSE")
        if _key
        else f"SELECT * FROM raw_{_table} WHERE _is_deleted = FALSE"
    )
    _email = " REPLACE (lower(email) AS email)" if _table == "contacts" else ""
    MODELS[f"stg_crm__{_table}"] = f"SELECT * EXCLUDE (_is_deleted){_email} FROM ({_rows})"

MODELS["telemetry"] = """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(_loaded_at AS DATE) AS _ingestion_date
FROM raw_telemetry_readings"""

_PAYLOAD_SQL = {
    "energy_readings": (
        "energy_reading",
        "CAST(reading AS DECIMAL(12,4)) AS kwh_reading, "
        "CAST(230 + CAST(k AS DOUBLE) / 10 AS DECIMAL(8,2)) AS voltage, "
        "CAST(CAST(k AS DOUBLE) / 4 AS DECIMAL(8,2)) AS current_amps",
    ),
    "device_status": (
        "device_status",
        "CASE WHEN cause = 'click' THEN 'online' WHEN k < 50 THEN 'offline' ELSE 'degraded' END AS status, "
        "CASE WHEN k >= 10 THEN k END AS battery_level, -k AS signal_strength",
    ),
    "temperature_readings": (
        "temperature_reading",
        "CAST(reading AS DECIMAL(6,2)) AS temperature_celsius, k AS humidity_percent, "
        "CAST(21.5 AS DECIMAL(6,2)) AS target_temperature",
    ),
    "alert_events": (
        "alert_event",
        "'threshold' AS alert_type, "
        "CASE WHEN k >= 66 THEN 'critical' WHEN k >= 33 THEN 'warning' ELSE 'info' END AS severity, "
        "'k=' || k AS message, CAST(k AS DECIMAL(12,4)) AS threshold_value, "
        "CAST(reading AS DECIMAL(12,4)) AS actual_value",
    ),
}
for _model, (_type, _fields) in _PAYLOAD_SQL.items():
    MODELS[f"stg_iot__{_model}"] = (
        f"SELECT device_id, event_timestamp, {_fields}, _loaded_at, _ingestion_date FROM ("
        + latest("telemetry", "device_id, event_timestamp", "_loaded_at", f"event_type = '{_type}'")
        + ")"
    )

MODELS |= {
    "stg_partner__grid_usage": "SELECT * FROM raw_grid_usage_readings",
    "stg_partner__installation_certifications": "SELECT * FROM raw_installation_certifications",
    "stg_partner__product_catalog": latest(
        "raw_product_catalog_updates", "product_id",
        "effective_date, _loaded_at, _source_file_name, _source_file_row_number",
    ),
    "int_billing__invoice_enriched": """
SELECT li.* EXCLUDE (description, created_at, updated_at, _source_ts, _loaded_at, _connector_batch_id),
    li.description AS line_description, i.customer_id, i.household_id, i.contract_id, i.invoice_date, i.due_date,
    i.status AS invoice_status, p.product_name, p.category AS product_category, p.pricing_tier, k.contract_type,
    k.tariff_plan_id, amount - coalesce(li.tax_amount, 0) AS net_amount,
    coalesce(map {'device': 'hardware_revenue', 'service': 'service_revenue', 'bundle': 'bundle_revenue'}[p.category],
        'other_revenue') AS revenue_classification
FROM stg_oltp__invoice_line_items li JOIN stg_oltp__invoices i USING (invoice_id)
LEFT JOIN stg_oltp__products p USING (product_id) LEFT JOIN stg_oltp__contracts k USING (contract_id)""",
    "int_customer__unified_profile": """
SELECT DISTINCT ON (o.customer_id) o.* EXCLUDE (email, _source_ts, _loaded_at, _connector_batch_id),
    o.email AS oltp_email, c.contact_id AS crm_contact_id, c.account_id AS crm_account_id, c.title AS crm_title,
    c.department AS crm_department, a.account_name AS crm_account_name,
    if(c.contact_id IS NULL, 'oltp_only', 'matched') AS match_status
FROM stg_oltp__customers o
LEFT JOIN stg_crm__contacts c ON lower(o.email) = lower(c.email)
LEFT JOIN stg_crm__accounts a USING (account_id)
ORDER BY o.customer_id, c.contact_id IS NULL, c.last_modified_date DESC NULLS LAST,
    c.created_date DESC NULLS LAST, c.contact_id DESC NULLS LAST""",
    "int_device__lifecycle": f"""
SELECT d.* EXCLUDE (status, _source_ts, _loaded_at, _connector_batch_id), d.status AS source_status,
    s.status AS latest_telemetry_status, s.event_timestamp AS last_status_timestamp,
    coalesce(
        if(d.status = 'decommissioned' OR (s.status = 'offline'
            AND date_diff('hour', s.event_timestamp, {NOW}) > 72), 'decommissioned', NULL),
        CASE s.status WHEN 'degraded' THEN 'degraded' WHEN 'offline' THEN 'inactive' WHEN 'online' THEN 'active' END,
        if(d.status = 'active' AND d.installed_at IS NOT NULL, 'active', 'provisioned')) AS lifecycle_state
FROM stg_oltp__devices d LEFT JOIN (
    {latest("stg_iot__device_status", "device_id", "event_timestamp")}
) s ON CAST(d.device_id AS VARCHAR) = s.device_id""",
    "int_device__telemetry_daily": """
SELECT coalesce(e.device_id, t.device_id) AS device_id, coalesce(e.reading_date, t.reading_date) AS reading_date,
    e.total_kwh, e.peak_kwh, t.avg_temperature, coalesce(e.n, 0) + coalesce(t.n, 0) AS total_reading_count
FROM (SELECT device_id, CAST(event_timestamp AS DATE) AS reading_date, sum(kwh_reading) AS total_kwh,
        max(kwh_reading) AS peak_kwh, count(*) AS n FROM stg_iot__energy_readings GROUP BY 1, 2) e
FULL JOIN (SELECT device_id, CAST(event_timestamp AS DATE) AS reading_date,
        round(CAST(sum(temperature_celsius) AS DOUBLE) / count(*), 6) AS avg_temperature, count(*) AS n
        FROM stg_iot__temperature_readings GROUP BY 1, 2) t
    ON e.device_id = t.device_id AND e.reading_date = t.reading_date""",
    "int_service__ticket_enriched": """
SELECT t.* EXCLUDE (_loaded_at, _sync_id, first_response_at, comment_count), t.first_response_at, t.comment_count,
    p.email AS contact_email, CAST(opened_at + INTERVAL 1 DAY AS DATE) AS assigned_at,
    if(ticket_status = 'closed', closed_at, NULL) AS resolved_at, CAST(24 AS BIGINT) AS time_to_assign_hours,
    date_diff('hour', opened_at, first_response_at) AS time_to_first_response_hours,
    date_diff('hour', opened_at, closed_at) AS time_to_resolve_hours
FROM (SELECT * RENAME (case_id AS ticket_id, status AS ticket_status, created_date AS opened_at, closed_date AS closed_at)
    FROM stg_crm__cases LEFT JOIN (SELECT case_id, min(created_date) AS first_response_at, count(*) AS comment_count
        FROM stg_crm__case_comments GROUP BY case_id) USING (case_id)) t
LEFT JOIN stg_crm__contacts p USING (contact_id)""",
    "dim_customer": f"""
SELECT {sk('customer_id', 'updated_at')} AS customer_sk, customer_id, email, first_name, last_name, phone,
    address, postal_code, municipality, region, country, segment, status, valid_from, valid_to,
    valid_to IS NULL AS is_current
FROM snp_customers""",
    "dim_contract": f"""
SELECT {sk('contract_id', 'updated_at')} AS contract_sk, contract_id, customer_id, household_id, product_id,
    tariff_plan_id, contract_type, status, start_date, end_date, monthly_amount, created_at, updated_at,
    valid_from, valid_to, valid_to IS NULL AS is_current
FROM snp_contracts""",
    "dim_device": f"""
SELECT {sk('device_id')} AS device_sk, device_id, device_serial, household_id, device_type, manufacturer, model,
    firmware_version, installed_at, lifecycle_state, created_at, updated_at
FROM int_device__lifecycle""",
    "dim_household": f"""
SELECT {sk('household_id')} AS household_sk, household_id, customer_id, address, postal_code, municipality,
    country, household_type, created_at, updated_at
FROM stg_oltp__households""",
    "dim_product": f"""
SELECT {sk('product_id')} AS product_sk, product_id, product_name, category, description, pricing_tier,
    is_active, created_at, updated_at
FROM stg_oltp__products""",
    "dim_date": f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, dayname(d) AS day_of_week,
    isodow(d) AS day_of_week_num, week(d) AS week_number_iso, month(d) AS month, monthname(d) AS month_name,
    quarter(d) AS quarter, year(d) AS year, isodow(d) >= 6 AS is_weekend,
    strftime(d, '%m-%d') IN ('01-01', '06-05', '12-24', '12-25', '12-26') AS is_danish_public_holiday,
    year(d) AS fiscal_year, quarter(d) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS d)""",
    # Every day of the years that the facts lie in.
    "dated": """
SELECT min(d) AS first, max(d) AS last FROM (
    SELECT invoice_date AS d FROM stg_oltp__invoices UNION ALL SELECT payment_date FROM stg_oltp__payments
    UNION ALL SELECT start_date FROM stg_oltp__contracts UNION ALL SELECT end_date FROM stg_oltp__contracts
    UNION ALL SELECT CAST(event_timestamp AS DATE) FROM telemetry
    UNION ALL SELECT created_date FROM stg_crm__cases UNION ALL SELECT closed_date FROM stg_crm__cases)""",
    "dim_time": """
SELECT h * 100 + m AS time_key, h AS hour, m AS minute,
    CASE WHEN h < 6 THEN 'night' WHEN h < 12 THEN 'morning' WHEN h < 18 THEN 'afternoon' ELSE 'evening' END
        AS time_of_day_band, h BETWEEN 8 AND 16 AS is_business_hour
FROM (SELECT i // 60 AS h, i % 60 AS m FROM range(1440) r(i))""",
    "dim_geography": f"""
SELECT {sk('postal_code', 'municipality', 'country')} AS geography_sk, * FROM (
    SELECT postal_code, municipality, country, min(region) AS region FROM (
        SELECT postal_code, municipality, country, region FROM stg_oltp__customers
        UNION ALL BY NAME SELECT postal_code, municipality, country FROM stg_oltp__households)
    WHERE postal_code IS NOT NULL GROUP BY ALL)""",
    "bridge_household_device": """
SELECT household_sk, device_sk, device_id, household_id, installed_at AS effective_from,
    if(lifecycle_state = 'decommissioned', updated_at, NULL) AS effective_to
FROM dim_device JOIN (SELECT household_sk, household_id FROM dim_household) USING (household_id)""",
    "fct_invoices": f"""
SELECT {sk('line_item_id')} AS invoice_line_sk, customer_sk, household_sk, product_sk, contract_sk,
    invoice_date_key, line_item_id, invoice_id, line_description, quantity, unit_price, amount, tax_amount,
    net_amount, invoice_status, product_category, revenue_classification
FROM ({star("int_billing__invoice_enriched", "customer household product contract", "invoice_date")})""",
    "fct_payments": f"""
SELECT {sk('payment_id')} AS payment_sk, customer_sk, household_sk, contract_sk, payment_date_key, payment_id,
    invoice_id, payment_amount, payment_method, status AS payment_status,
    coalesce(payment_date > due_date, FALSE) AS is_late_payment
FROM ({star("(SELECT p.*, i.household_id, i.contract_id, i.due_date FROM stg_oltp__payments p "
            "LEFT JOIN stg_oltp__invoices i USING (invoice_id))", "customer household contract", "payment_date")})""",
    "fct_contract_lifecycle": f"""
SELECT {sk('contract_id')} AS contract_lifecycle_sk, customer_sk, household_sk, product_sk, contract_sk,
    start_date_key, end_date_key, contract_id, contract_type, status, created_at,
    created_at AS created_at_milestone, monthly_amount,
    if(status IN ('active', 'renewed', 'cancelled', 'expired'), start_date, NULL) AS activated_at,
    if(status = 'renewed', updated_at, NULL) AS renewed_at, if(status = 'cancelled', updated_at, NULL) AS cancelled_at,
    coalesce(end_date, CAST({NOW} AS DATE)) - start_date AS contract_duration_days
FROM ({star("stg_oltp__contracts", "customer household product contract", "start_date end_date")})""",
    "all_events": """
SELECT device_id, event_timestamp, 'energy_reading' AS event_type, CAST(kwh_reading AS DECIMAL(12,4)) AS reading_value
FROM stg_iot__energy_readings
UNION ALL SELECT device_id, event_timestamp, 'temperature_reading', CAST(temperature_celsius AS DECIMAL(12,4))
FROM stg_iot__temperature_readings
UNION ALL SELECT device_id, event_timestamp, 'device_status', CAST(NULL AS DECIMAL(12,4)) FROM stg_iot__device_status
UNION ALL SELECT device_id, event_timestamp, 'alert_event', actual_value FROM stg_iot__alert_events""",
    "fct_device_telemetry": f"""
SELECT {sk("device_id", "event_timestamp", "event_type", "coalesce(CAST(reading_value AS VARCHAR), '__NULL__')", "n")}
    AS telemetry_sk, device_sk, household_sk, day_key AS date_key, time_key, device_id, event_timestamp, event_type,
    reading_value
FROM ({star('''(SELECT e.*, CAST(event_timestamp AS DATE) AS day, row_number() OVER (
        PARTITION BY device_id, event_timestamp, event_type ORDER BY coalesce(reading_value, -999999999)) AS n,
        d.device_sk, d.household_id
    FROM all_events e LEFT JOIN (SELECT * RENAME (device_id AS number) FROM dim_device) d
        ON e.device_id = CAST(d.number AS VARCHAR))''', "household", "day")})
LEFT JOIN dim_time ON time_key = hour(event_timestamp) * 100 + minute(event_timestamp)""",
    "fct_energy_usage_daily": f"""
SELECT {sk('device_id', 'reading_date')} AS energy_usage_daily_sk, device_sk, household_sk, customer_sk,
    reading_date_key AS date_key, device_id, reading_date, total_kwh, peak_kwh, avg_temperature,
    total_reading_count AS reading_count
FROM ({star('''(SELECT u.*, d.device_sk, d.household_id, h.customer_id
    FROM int_device__telemetry_daily u
    LEFT JOIN (SELECT * RENAME (device_id AS number) FROM dim_device) d ON u.device_id = CAST(d.number AS VARCHAR)
    LEFT JOIN stg_oltp__households h USING (household_id))''', "household customer", "reading_date")})""",
    "fct_service_ticket_lifecycle": f"""
SELECT {sk('ticket_id')} AS service_ticket_sk, opened_at_key AS opened_date_key, closed_at_key AS closed_date_key,
    * EXCLUDE (account_id, contact_id, contact_email, description, last_modified_date, opened_at_key, closed_at_key)
FROM ({star("int_service__ticket_enriched", "", "opened_at closed_at")})""",
    "bridge_service_ticket_customer": f"""
SELECT {sk('ticket_id', 'customer_sk')} AS service_ticket_customer_sk, ticket_id, customer_sk, customer_id,
    CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY ticket_id) AS allocation_pct
FROM (SELECT DISTINCT t.ticket_id, c.customer_sk, c.customer_id
    FROM int_service__ticket_enriched t
    JOIN int_customer__unified_profile p ON t.contact_id = p.crm_contact_id
    JOIN dim_customer c ON p.customer_id = c.customer_id AND c.is_current)""",
    "customer_360": f"""
SELECT {sk('customer_id')} AS customer_360_sk, u.* EXCLUDE (crm_account_id) RENAME (oltp_email AS email),
    {", ".join(f"coalesce({c}, 0) AS {c}" for c in (
        "total_contracts", "active_contracts", "active_device_count", "total_device_count",
        "lifetime_invoice_total", "total_service_tickets"))},
    list_max([TIMESTAMP '1900-01-01', billed, asked, updated_at]) AS last_interaction_date
FROM int_customer__unified_profile u
LEFT JOIN (SELECT customer_id, count(*) AS total_contracts, count_if(status = 'active') AS active_contracts
    FROM stg_oltp__contracts GROUP BY ALL) USING (customer_id)
LEFT JOIN (SELECT h.customer_id, count(*) AS total_device_count, count_if(lifecycle_state = 'active') AS active_device_count
    FROM int_device__lifecycle JOIN stg_oltp__households h USING (household_id) GROUP BY ALL) USING (customer_id)
LEFT JOIN (SELECT customer_id, sum(total_amount) AS lifetime_invoice_total, CAST(max(invoice_date) AS TIMESTAMP) AS billed
    FROM stg_oltp__invoices GROUP BY ALL) USING (customer_id)
LEFT JOIN (SELECT customer_id, count(DISTINCT ticket_id) AS total_service_tickets, CAST(max(opened_at) AS TIMESTAMP) AS asked
    FROM bridge_service_ticket_customer JOIN fct_service_ticket_lifecycle USING (ticket_id) GROUP BY ALL) USING (customer_id)""",
    "invoice_star": """
SELECT f.*, c.customer_id, c.segment, c.region, k.contract_type, p.category, d.year, d.quarter, d.month_name
FROM fct_invoices f
LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk LEFT JOIN dim_contract k ON f.contract_sk = k.contract_sk
LEFT JOIN dim_product p ON f.product_sk = p.product_sk LEFT JOIN dim_date d ON f.invoice_date_key = d.date_key""",
    "payment_star": """
SELECT f.*, c.customer_id, c.segment, c.region, k.contract_type, d.year, d.quarter, d.month_name
FROM fct_payments f
LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk LEFT JOIN dim_contract k ON f.contract_sk = k.contract_sk
LEFT JOIN dim_date d ON f.payment_date_key = d.date_key""",
    # Contract versions out of the order log, and the same with ends that are too late.
    "versions": """
SELECT *, lead(_source_ts) OVER (PARTITION BY contract_id ORDER BY _source_ts) AS valid_to, _source_ts AS valid_from
FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, _source_ts
    ORDER BY _loaded_at DESC, _connector_batch_id DESC) AS rn FROM raw_contracts WHERE _op <> 'DELETE') WHERE rn = 1)""",
    "late_versions": """
SELECT contract_id, valid_from, valid_to + INTERVAL 30 DAY AS valid_to FROM versions""",
    "broken_versions": """
SELECT contract_id, valid_from, valid_from + INTERVAL 400 DAY AS valid_to FROM versions""",
}


def query(select: str, doubles: str = "") -> str:
    """A complete statement: the models ``select`` uses, then ``select`` itself."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in MODELS:
            if name not in order and re.search(rf"\b{name}\b", sql):
                visit(MODELS[name])
                if name not in order:
                    order.append(name)

    visit(select)
    if doubles:
        casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split())
        select = f"SELECT * REPLACE ({casts}) FROM ({select})"
    if not order:
        return select
    # MATERIALIZED: several models are used more than once.
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({MODELS[name].strip()})" for name in order)
    return f"WITH {ctes}\n{select}"
