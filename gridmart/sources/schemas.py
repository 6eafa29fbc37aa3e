"""Column lists of the raw tables, as Spark DDL.

Fixed values: names and types of the feeds. Change logs and sync tables share their
envelope columns, so only the entity columns are listed per table.
"""

from __future__ import annotations

MONEY = "decimal(12,2)"

_CDC_HEAD = (
    "_op string, _source_ts timestamp_ntz, _loaded_at timestamp_ntz, _connector_batch_id string"
)
_CDC_TAIL = "created_at timestamp_ntz, updated_at timestamp_ntz"
_SAAS_HEAD = "_loaded_at timestamp_ntz, _sync_id string, _is_deleted boolean"
_FILE_TAIL = (
    "_loaded_at timestamp_ntz, _source_file_name string, _source_file_row_number bigint"
)

_OLTP = {
    "customers": "customer_id bigint, email string, first_name string, last_name string, "
    "phone string, address string, postal_code string, municipality string, region string, "
    "country string, segment string, status string",
    "households": "household_id bigint, customer_id bigint, address string, "
    "postal_code string, municipality string, country string, household_type string",
    "installations": "installation_id bigint, household_id bigint, installation_date date, "
    "installer_partner_id string, status string, notes string",
    "devices": "device_id bigint, device_serial string, household_id bigint, "
    "device_type string, manufacturer string, model string, firmware_version string, "
    "installed_at date, status string",
    "contracts": "contract_id bigint, customer_id bigint, household_id bigint, "
    "product_id bigint, tariff_plan_id bigint, contract_type string, status string, "
    f"start_date date, end_date date, monthly_amount {MONEY}",
    "tariff_plans": "tariff_plan_id bigint, plan_name string, plan_type string, "
    f"price_per_kwh {MONEY}, monthly_base_fee {MONEY}, valid_from date, valid_to date",
    "products": "product_id bigint, product_name string, category string, "
    "description string, pricing_tier string, is_active boolean",
    "services": "service_id bigint, service_name string, category string, "
    "description string, is_active boolean",
    "invoices": "invoice_id bigint, customer_id bigint, household_id bigint, "
    "contract_id bigint, invoice_date date, due_date date, "
    f"total_amount {MONEY}, tax_amount {MONEY}, status string",
    "invoice_line_items": "line_item_id bigint, invoice_id bigint, product_id bigint, "
    f"description string, quantity bigint, unit_price {MONEY}, amount {MONEY}, "
    f"tax_amount {MONEY}",
    "payments": "payment_id bigint, invoice_id bigint, customer_id bigint, "
    f"payment_date date, payment_amount {MONEY}, payment_method string, status string",
}

_CRM = {
    "accounts": "account_id string, account_name string, industry string, website string, "
    "phone string, billing_address string, region string, owner_id string, "
    "created_date date, last_modified_date date",
    "contacts": "contact_id string, account_id string, first_name string, last_name string, "
    "email string, phone string, title string, department string, created_date date, "
    "last_modified_date date",
    "cases": "case_id string, account_id string, contact_id string, subject string, "
    "description string, status string, priority string, severity string, origin string, "
    "created_date date, closed_date date, last_modified_date date",
    "case_comments": "comment_id string, case_id string, body string, is_public boolean, "
    "created_by string, created_date date",
    "opportunities": "opportunity_id string, account_id string, name string, stage string, "
    f"amount {MONEY}, close_date date, probability bigint, created_date date, "
    "last_modified_date date",
    "tasks": "task_id string, account_id string, contact_id string, subject string, "
    "status string, priority string, due_date date, completed_date date, created_date date",
    "campaigns": "campaign_id string, name string, type string, status string, "
    f"start_date date, end_date date, budget {MONEY}, actual_cost {MONEY}, created_date date",
    "campaign_members": "member_id string, campaign_id string, contact_id string, "
    "status string, first_responded_date date, created_date date",
}

_PARTNER = {
    "grid_usage_readings": "reading_id string, meter_id string, household_id bigint, "
    f"reading_date date, kwh_consumed {MONEY}, kwh_produced {MONEY}, "
    f"peak_demand_kw {MONEY}, reading_source string",
    "installation_certifications": "certification_id string, installation_id bigint, "
    "installer_id string, certification_date date, certification_type string, "
    "expiry_date date, status string, inspector_name string",
    "product_catalog_updates": "product_id bigint, product_name string, category string, "
    "manufacturer string, model_number string, specifications string, "
    f"list_price {MONEY}, effective_date date, is_discontinued boolean",
}

TELEMETRY = (
    "event_data variant, device_id string, event_type string, "
    "event_timestamp timestamp_ntz, _loaded_at timestamp_ntz, _ingestion_date date"
)

# Payload fields of each event type: output column -> (payload field, type).
PAYLOADS = {
    "energy_reading": {
        "kwh_reading": ("kwh_reading", "decimal(12,4)"),
        "voltage": ("voltage", "decimal(8,2)"),
        "current_amps": ("current", "decimal(8,2)"),
    },
    "device_status": {
        "status": ("status", "string"),
        "battery_level": ("battery_level", "int"),
        "signal_strength": ("signal_strength", "int"),
    },
    "temperature_reading": {
        "temperature_celsius": ("temperature_celsius", "decimal(6,2)"),
        "humidity_percent": ("humidity_percent", "int"),
        "target_temperature": ("target_temperature", "decimal(6,2)"),
    },
    "alert_event": {
        "alert_type": ("alert_type", "string"),
        "severity": ("severity", "string"),
        "message": ("message", "string"),
        "threshold_value": ("threshold_value", "decimal(12,4)"),
        "actual_value": ("actual_value", "decimal(12,4)"),
    },
}

FILE_ERRORS = (
    "file_name string, error_type string, error_message string, record_count bigint, "
    "logged_at timestamp_ntz"
)


def raw_tables() -> dict[str, str]:
    """Raw table name -> DDL, envelope included."""
    tables = {name: f"{_CDC_HEAD}, {cols}, {_CDC_TAIL}" for name, cols in _OLTP.items()}
    tables |= {name: f"{_SAAS_HEAD}, {cols}" for name, cols in _CRM.items()}
    tables |= {name: f"{cols}, {_FILE_TAIL}" for name, cols in _PARTNER.items()}
    tables["telemetry_events"] = TELEMETRY
    return tables


def file_columns(table: str) -> str:
    """What a CSV file of the table carries; the load stamps the rest itself."""
    if table in _OLTP:
        head = _CDC_HEAD.replace("_loaded_at timestamp_ntz, ", "")
        return f"{head}, {_OLTP[table]}, {_CDC_TAIL}"
    if table in _CRM:
        return f"{_SAAS_HEAD}, {_CRM[table]}"
    return _PARTNER[table]
