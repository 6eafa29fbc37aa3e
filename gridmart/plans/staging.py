"""Raw tables to typed current rows: 26 staging models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import payload_field, title_case
from ..operators.current import (
    cdc_current,
    latest_effective,
    latest_per_key,
    newest_first,
    saas_current,
    saas_filtered,
    telemetry_stage,
)
from ..sources.schemas import PAYLOADS, raw_tables

# Change logs and their keys.
CDC_KEYS = {
    "contracts": "contract_id",
    "customers": "customer_id",
    "devices": "device_id",
    "households": "household_id",
    "installations": "installation_id",
    "invoice_line_items": "line_item_id",
    "invoices": "invoice_id",
    "payments": "payment_id",
    "products": "product_id",
    "services": "service_id",
    "tariff_plans": "tariff_plan_id",
}
# Sync tables: those with a key are reduced to the latest row, the others only filtered.
SAAS_KEYS = {
    "accounts": "account_id",
    "contacts": "contact_id",
    "cases": "case_id",
    "campaign_members": None,
    "campaigns": None,
    "case_comments": None,
    "opportunities": None,
    "tasks": None,
}
TELEMETRY_MODELS = {
    "alert_events": "alert_event",
    "device_status": "device_status",
    "energy_readings": "energy_reading",
    "temperature_readings": "temperature_reading",
}
TELEMETRY_KEY = ["device_id", "event_timestamp", "event_type"]


def typed(df: DataFrame, table: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Cast every column the raw schema declares to its declared type."""
    declared = StructType.fromDDL(raw_tables()[table])
    found = df.schema
    if {(f.name, f.dataType) for f in declared} == {(f.name, f.dataType) for f in found}:
        return df.drop(*drop)

    def column(field) -> Column:
        same = found[field.name].dataType == field.dataType
        return F.col(field.name) if same else F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in declared if f.name not in drop])


def cdc_model(log: DataFrame, table: str, drop_deleted: bool = False) -> DataFrame:
    current = typed(cdc_current(log, CDC_KEYS[table], drop_deleted=drop_deleted), table, ("_op",))
    if table == "customers":
        return current.withColumns(
            {
                "email": F.lower("email"),
                "first_name": title_case(F.col("first_name")),
                "last_name": title_case(F.col("last_name")),
            }
        )
    return current


def saas_model(sync: DataFrame, table: str) -> DataFrame:
    key = SAAS_KEYS[table]
    rows = saas_current(sync, key) if key else saas_filtered(sync)
    model = typed(rows, table, ("_is_deleted",))
    return model.withColumn("email", F.lower("email")) if table == "contacts" else model


def telemetry_model(
    events: DataFrame, model: str, loaded_from: Column | None = None
) -> DataFrame:
    event_type = TELEMETRY_MODELS[model]
    return telemetry_stage(events, event_type, PAYLOADS[event_type], loaded_from)


def telemetry_all(events: DataFrame, loaded_from: Column | None = None) -> DataFrame:
    """All four event types in one scan and one shuffle: one row per device, time and type.

    Holds every type's fields, NULL where a row is of another type. ``loaded_from`` is the
    high-water mark of an incremental run; rows loaded at the mark itself are read again.
    """
    wanted = events.filter(F.col("event_type").isin(*TELEMETRY_MODELS.values()))
    if loaded_from is not None:
        wanted = wanted.filter(F.col("_loaded_at") >= loaded_from)
    fields = {
        name: F.when(
            F.col("event_type") == event_type,
            payload_field(events, "event_data", f"$.payload.{source}", data_type),
        ).alias(name)
        for event_type in TELEMETRY_MODELS.values()
        for name, (source, data_type) in PAYLOADS[event_type].items()
    }
    rows = wanted.select(*TELEMETRY_KEY, *fields.values(), "_loaded_at", "_ingestion_date")
    return latest_deliveries(rows)


def latest_deliveries(rows: DataFrame) -> DataFrame:
    """One row per event of `telemetry_all`, the newest; of equally new ones, by content."""
    fields = [c for c in rows.columns if c not in (*TELEMETRY_KEY, "_loaded_at", "_ingestion_date")]
    return latest_per_key(rows, TELEMETRY_KEY, newest_first("_loaded_at", *fields))


def telemetry_of(staged: DataFrame, model: str) -> DataFrame:
    """One type's model out of `telemetry_all`."""
    event_type = TELEMETRY_MODELS[model]
    return staged.filter(F.col("event_type") == event_type).select(
        "device_id", "event_timestamp", *PAYLOADS[event_type], "_loaded_at", "_ingestion_date"
    )


def partner_model(feed: DataFrame, table: str) -> DataFrame:
    """Typed pass-through with lineage (C5); the catalog keeps the newest row per product."""
    if table == "product_catalog_updates":
        feed = latest_effective(feed, "product_id")
    return typed(feed, table)
