"""Lookup queries (V1-V4, P11, P13, L1-L3). Inputs are bound as literals, never as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boundaries_between, contains_ignoring_case
from ..operators.current import latest_per_key, newest_first
from .marts import current

# Result sizes and the minutes that separate the connectivity states.
SEARCH_ROWS = 20
RECENT_INVOICES = 25
ONLINE_MINUTES, STALE_MINUTES = 15, 60


def customer_search(profile: DataFrame, term: str, rows: int = SEARCH_ROWS) -> DataFrame:
    """Customers whose email or full name contains the term, lowest ids first (V1)."""
    name = F.concat("first_name", F.lit(" "), "last_name")
    hit = contains_ignoring_case(F.col("email"), term) | contains_ignoring_case(name, term)
    return (
        profile.filter(hit)
        .select(
            "customer_id", "email", "first_name", "last_name", "segment", "region", "country",
            "status", "total_contracts", "active_contracts", "active_device_count",
            "lifetime_invoice_total", "total_service_tickets",
        )
        .orderBy("customer_id")
        .limit(rows)
    )


def _as_key(df: DataFrame, column: str, value) -> Column:
    """The input is cast to the key's type, so the filter still reaches the scan."""
    return F.col(column) == F.lit(value).cast(df.schema[column].dataType)


def customer_contracts(contracts: DataFrame, customer_id) -> DataFrame:
    """Current contracts of a customer, newest first (V2)."""
    return (
        current(contracts)
        .filter(_as_key(contracts, "customer_id", customer_id))
        .select("contract_id", "contract_type", "status", "start_date", "end_date", "monthly_amount")
        .orderBy(F.col("start_date").desc_nulls_last(), "contract_id")
    )


def customer_keys(customers: DataFrame, customer_id) -> list[str]:
    """The current keys of a customer (one, unless the dimension is broken), read now."""
    rows = current(customers).filter(_as_key(customers, "customer_id", customer_id))
    return [r[0] for r in rows.select("customer_sk").distinct().collect()]


def recent_invoices(
    invoices: DataFrame, customers: DataFrame, customer_id, rows: int = RECENT_INVOICES, point: bool = False
) -> DataFrame:
    """Newest invoice lines of a customer, through the current customer key (V3).

    ``point`` looks the key up first and filters by its value, which files made for lookups can skip by;
    otherwise it is one lazy plan, a semi join.
    """
    if point:
        of_customer = invoices.filter(F.col("customer_sk").isin(customer_keys(customers, customer_id)))
    else:
        who = (
            current(customers)
            .filter(_as_key(customers, "customer_id", customer_id))
            .select(F.col("customer_sk").alias("_sk"))
        )
        of_customer = invoices.join(who, F.col("customer_sk") == F.col("_sk"), "left_semi")
    return (
        of_customer.orderBy(F.col("invoice_date_key").desc_nulls_last(), "line_item_id")
        .limit(rows)
        .select(
            "invoice_id", "line_description", "quantity", "amount", "tax_amount", "net_amount",
            "invoice_status", "revenue_classification",
        )
    )


def connectivity(last_seen: Column, as_of: Column) -> Column:
    """online / stale / offline from the minutes since the last event."""
    silent = boundaries_between("minute", last_seen, as_of)
    return (
        F.when(silent <= ONLINE_MINUTES, "online")
        .when(silent <= STALE_MINUTES, "stale")
        .otherwise("offline")
    )


def device_latest_status(events: DataFrame, as_of: Column) -> DataFrame:
    """Latest event of every device and what it says about its connection.

    Events of a device at the same instant are told apart by load time, then type.
    """
    latest = latest_per_key(
        events, ["device_id"], newest_first("event_timestamp", "_loaded_at", "event_type")
    )
    return latest.select(
        "device_id",
        F.col("event_type").alias("latest_event_type"),
        F.col("event_timestamp").alias("latest_event_timestamp"),
        F.col("event_data").alias("latest_event_data"),
        F.col("_loaded_at").alias("latest_loaded_at"),
        connectivity(F.col("event_timestamp"), as_of).alias("device_connectivity_status"),
    )
