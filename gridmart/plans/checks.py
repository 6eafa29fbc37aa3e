"""Which checks every mart has to pass (D1-D14), and the record of row counts that D8 reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..sources.sinks import write_table

Lookup = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """``failing(models)`` gives the rows of ``model`` that fail; none if it passes."""

    model: str
    name: str
    failing: Callable[[Lookup], DataFrame]


def _columns(model: str, not_null: str = "", unique: str = "") -> list[Check]:
    return [
        *[Check(model, f"not_null_{c}", lambda m, c=c: Q.not_null(m[model], c)) for c in not_null.split()],
        *[Check(model, f"unique_{c}", lambda m, c=c: Q.unique(m[model], c)) for c in unique.split()],
    ]


def _collision(model: str, key: str, *natural: str) -> Check:
    return Check(model, f"collision_{key}", lambda m: Q.surrogate_key_collision(m[model], key, natural))


def _values(model: str, column: str, values: tuple[str, ...]) -> Check:
    return Check(model, f"accepted_{column}", lambda m: Q.accepted_values(m[model], column, values))


def _parents(model: str, **fields: str) -> list[Check]:
    """``column="parent.field"``: every non-NULL key has its parent."""
    return [
        Check(model, f"parent_of_{c}", lambda m, c=c, p=to.split("."): Q.relationships(m[model], c, m[p[0]], p[1]))
        for c, to in fields.items()
    ]


def _no_overlap(model: str, key: str) -> Check:
    return Check(model, f"no_overlap_{key}", lambda m: Q.scd2_no_overlap(m[model], key))


# Which columns of which mart are checked for what.
CHECKS: tuple[Check, ...] = (
    *_columns("dim_customer", "customer_sk customer_id valid_from is_current", "customer_sk"),
    _collision("dim_customer", "customer_sk", "customer_id", "valid_from"),
    _no_overlap("dim_customer", "customer_id"),
    *_columns("dim_household", "household_sk household_id customer_id", "household_sk household_id"),
    _collision("dim_household", "household_sk", "household_id"),
    *_columns("dim_device", "device_sk device_id", "device_sk device_id"),
    _collision("dim_device", "device_sk", "device_id"),
    _values("dim_device", "lifecycle_state", Q.LIFECYCLE_STATES),
    *_columns("dim_product", "product_sk product_id", "product_sk product_id"),
    _collision("dim_product", "product_sk", "product_id"),
    *_columns("dim_contract", "contract_sk contract_id valid_from is_current", "contract_sk"),
    _collision("dim_contract", "contract_sk", "contract_id", "valid_from"),
    _no_overlap("dim_contract", "contract_id"),
    *_columns("dim_date", "date_key full_date", "date_key full_date"),
    *_columns("dim_time", "time_key", "time_key"),
    *_columns("dim_geography", "geography_sk", "geography_sk"),
    *_columns("fct_invoices", "invoice_line_sk line_item_id", "invoice_line_sk"),
    *_parents("fct_invoices", customer_sk="dim_customer.customer_sk", household_sk="dim_household.household_sk",
              product_sk="dim_product.product_sk", contract_sk="dim_contract.contract_sk",
              invoice_date_key="dim_date.date_key"),
    *_columns("fct_payments", "payment_sk payment_id", "payment_sk"),
    *_parents("fct_payments", customer_sk="dim_customer.customer_sk", household_sk="dim_household.household_sk",
              contract_sk="dim_contract.contract_sk", payment_date_key="dim_date.date_key"),
    *_columns("fct_contract_lifecycle", "contract_lifecycle_sk contract_id", "contract_lifecycle_sk"),
    *_columns("fct_device_telemetry", "telemetry_sk", "telemetry_sk"),
    *_parents("fct_device_telemetry", device_sk="dim_device.device_sk", household_sk="dim_household.household_sk",
              date_key="dim_date.date_key", time_key="dim_time.time_key"),
    _values("fct_device_telemetry", "event_type", Q.EVENT_TYPES),
    *_columns("fct_energy_usage_daily", "energy_usage_daily_sk", "energy_usage_daily_sk"),
    *_parents("fct_energy_usage_daily", device_sk="dim_device.device_sk", household_sk="dim_household.household_sk",
              customer_sk="dim_customer.customer_sk", date_key="dim_date.date_key"),
    *_columns("fct_service_ticket_lifecycle", "service_ticket_sk ticket_id", "service_ticket_sk"),
    *_parents("fct_service_ticket_lifecycle", opened_date_key="dim_date.date_key"),
    *_columns("bridge_service_ticket_customer", "service_ticket_customer_sk ticket_id", "service_ticket_customer_sk"),
    *_parents("bridge_service_ticket_customer", customer_sk="dim_customer.customer_sk"),
    *_columns("customer_360", "customer_360_sk customer_id", "customer_360_sk customer_id"),
)


def failing_rows(models: Lookup, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """model, check, failing_row (as JSON) of everything that fails."""
    parts = None
    for check in checks:
        found = check.failing(models)
        part = found.select(
            F.lit(check.model).alias("model"),
            F.lit(check.name).alias("check"),
            F.to_json(F.struct(*found.columns)).alias("failing_row"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def write_failing_rows(models: Lookup, path: str, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """`failing_rows` as a table. The checks of one model run and give back their shuffle files before
    those of the next: together they shuffle more than the marts hold."""
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)
    found, mode = None, "overwrite"
    for own in by_model.values():
        found, mode = write_table(failing_rows(models, tuple(own)), path, mode), "append"
    return found.sparkSession.read.schema(found.schema).parquet(path)


def row_counts(models: Lookup, names, measured_at: Column) -> DataFrame:
    """model_name, row_count, measured_at of the named models: what `volume_anomaly` reads."""
    parts = None
    for name in names:
        part = models[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model_name"), "row_count", measured_at.cast("timestamp_ntz").alias("measured_at")
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts
