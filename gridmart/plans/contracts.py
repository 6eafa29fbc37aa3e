"""Declared schemas of the marts (D13) and their personal data.

Fixed values: column names and types, as consumers of the marts rely on them.
"""

from __future__ import annotations

_PLACE = "postal_code string, municipality string, region string, country string"
_STAMPS = "created_at timestamp_ntz, updated_at timestamp_ntz"
_PERSON = "email string, first_name string, last_name string, phone string, address string"
_VERSION = "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
_MONEY = "decimal(12,2)"

MART_SCHEMAS = {
    "dim_customer": f"customer_sk string, customer_id bigint, {_PERSON}, {_PLACE}, "
    f"segment string, status string, {_VERSION}",
    "dim_household": "household_sk string, household_id bigint, customer_id bigint, "
    "address string, postal_code string, municipality string, country string, "
    f"household_type string, {_STAMPS}",
    "dim_device": "device_sk string, device_id bigint, device_serial string, "
    "household_id bigint, device_type string, manufacturer string, model string, "
    f"firmware_version string, installed_at date, lifecycle_state string, {_STAMPS}",
    "dim_product": "product_sk string, product_id bigint, product_name string, "
    "category string, description string, pricing_tier string, is_active boolean, "
    f"{_STAMPS}",
    "dim_contract": "contract_sk string, contract_id bigint, customer_id bigint, "
    "household_id bigint, product_id bigint, tariff_plan_id bigint, contract_type string, "
    f"status string, start_date date, end_date date, monthly_amount {_MONEY}, {_STAMPS}, "
    f"{_VERSION}",
    "dim_date": "date_key int, full_date date, day_of_week string, day_of_week_num int, "
    "week_number_iso int, month int, month_name string, quarter int, year int, "
    "is_weekend boolean, is_danish_public_holiday boolean, fiscal_year int, "
    "fiscal_quarter int",
    "dim_time": "time_key int, hour int, minute int, time_of_day_band string, "
    "is_business_hour boolean",
    "dim_geography": f"geography_sk string, {_PLACE}",
    "bridge_household_device": "household_sk string, device_sk string, device_id bigint, "
    "household_id bigint, effective_from date, effective_to timestamp_ntz",
    "fct_invoices": "invoice_line_sk string, line_item_id bigint, invoice_id bigint, "
    "customer_sk string, household_sk string, product_sk string, contract_sk string, "
    f"invoice_date_key int, line_description string, quantity bigint, unit_price {_MONEY}, "
    f"amount {_MONEY}, tax_amount {_MONEY}, net_amount decimal(13,2), "
    "invoice_status string, product_category string, revenue_classification string",
    "fct_payments": "payment_sk string, payment_id bigint, invoice_id bigint, "
    "customer_sk string, household_sk string, contract_sk string, payment_date_key int, "
    f"payment_amount {_MONEY}, payment_method string, payment_status string, "
    "is_late_payment boolean",
    "fct_contract_lifecycle": "contract_lifecycle_sk string, contract_id bigint, "
    "customer_sk string, household_sk string, product_sk string, contract_sk string, "
    "start_date_key int, end_date_key int, contract_type string, status string, "
    "created_at timestamp_ntz, created_at_milestone timestamp_ntz, activated_at date, "
    "renewed_at timestamp_ntz, cancelled_at timestamp_ntz, contract_duration_days int, "
    f"monthly_amount {_MONEY}",
    "fct_device_telemetry": "telemetry_sk string, device_sk string, household_sk string, "
    "date_key int, time_key int, device_id string, event_timestamp timestamp_ntz, "
    "event_type string, reading_value decimal(12,4)",
    "fct_energy_usage_daily": "energy_usage_daily_sk string, device_sk string, "
    "household_sk string, customer_sk string, date_key int, device_id string, "
    "reading_date date, total_kwh decimal(22,4), peak_kwh decimal(12,4), "
    "avg_temperature decimal(10,6), reading_count bigint",
    "fct_service_ticket_lifecycle": "service_ticket_sk string, ticket_id string, "
    "opened_date_key int, closed_date_key int, subject string, ticket_status string, "
    "priority string, severity string, origin string, opened_at date, assigned_at date, "
    "first_response_at date, resolved_at date, closed_at date, "
    "time_to_assign_hours bigint, time_to_first_response_hours bigint, "
    "time_to_resolve_hours bigint, comment_count bigint",
    "bridge_service_ticket_customer": "service_ticket_customer_sk string, "
    "ticket_id string, customer_sk string, customer_id bigint, allocation_pct double",
    "customer_360": f"customer_360_sk string, customer_id bigint, {_PERSON}, {_PLACE}, "
    "segment string, status string, match_status string, crm_contact_id string, "
    "crm_account_name string, crm_title string, crm_department string, "
    "total_contracts bigint, active_contracts bigint, active_device_count bigint, "
    "total_device_count bigint, lifetime_invoice_total decimal(22,2), "
    f"total_service_tickets bigint, last_interaction_date timestamp_ntz, {_STAMPS}",
}

PII = {"customer_360": ("email", "first_name", "last_name", "phone", "address")}
