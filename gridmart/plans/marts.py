"""Dimensions, facts, bridges and the customer profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock_key, minute_of_day, surrogate_key
from ..operators.joins import equal_weights, lookup, one_per_key
from ..operators.slices import occurrence_ordinal
from .intermediate import invoice_lines, revenue

# Statuses a started contract can have, and stand-ins of the data model.
STARTED = ("active", "renewed", "cancelled", "expired")
BEGINNING_OF_TIME = "1900-01-01"
NULL_READING = "__NULL__"
NULL_READING_ORDER = -999999999
READING = "decimal(12,4)"


# --- dimensions -----------------------------------------------------------------------

def versioned_dimension(snapshot: DataFrame, key: str, name: str, attributes: list[str]) -> DataFrame:
    """One row per version, keyed by natural key and start.

    Takes the columns of a snapshot table, or ``valid_from`` / ``valid_to`` as the
    log-based builder names them.
    """
    if "dbt_valid_from" in snapshot.columns:
        snapshot = snapshot.withColumnsRenamed(
            {"dbt_valid_from": "valid_from", "dbt_valid_to": "valid_to"}
        )
    return snapshot.select(
        surrogate_key(key, "valid_from").alias(name),
        key,
        *attributes,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_customer(snapshot: DataFrame) -> DataFrame:
    return versioned_dimension(
        snapshot, "customer_id", "customer_sk",
        ["email", "first_name", "last_name", "phone", "address", "postal_code", "municipality",
         "region", "country", "segment", "status"],
    )


def dim_contract(snapshot: DataFrame) -> DataFrame:
    return versioned_dimension(
        snapshot, "contract_id", "contract_sk",
        ["customer_id", "household_id", "product_id", "tariff_plan_id", "contract_type", "status",
         "start_date", "end_date", "monthly_amount", "created_at", "updated_at"],
    )


def keyed_dimension(df: DataFrame, key: str, name: str, attributes: list[str]) -> DataFrame:
    """One row per natural key."""
    return df.select(surrogate_key(key).alias(name), key, *attributes)


def dim_device(lifecycle: DataFrame) -> DataFrame:
    return keyed_dimension(
        lifecycle, "device_id", "device_sk",
        ["device_serial", "household_id", "device_type", "manufacturer", "model",
         "firmware_version", "installed_at", "lifecycle_state", "created_at", "updated_at"],
    )


def dim_household(households: DataFrame) -> DataFrame:
    return keyed_dimension(
        households, "household_id", "household_sk",
        ["customer_id", "address", "postal_code", "municipality", "country", "household_type",
         "created_at", "updated_at"],
    )


def dim_product(products: DataFrame) -> DataFrame:
    return keyed_dimension(
        products, "product_id", "product_sk",
        ["product_name", "category", "description", "pricing_tier", "is_active", "created_at",
         "updated_at"],
    )


def dim_geography(customers: DataFrame, households: DataFrame) -> DataFrame:
    """Postal areas of customers and households.

    Areas meet on all three key columns, NULL matching NULL, and keep one region each,
    so the key stays unique. Both inputs shrink to distinct areas before anything joins.
    """
    area = ["postal_code", "municipality", "country"]
    regions = (
        customers.filter(F.col("postal_code").isNotNull())
        .groupBy(*area)
        .agg(F.min("region").alias("region"))
    )
    bare = households.filter(F.col("postal_code").isNotNull()).select(
        *area, F.lit(None).cast("string").alias("region")
    )
    areas = regions.unionByName(bare.distinct()).groupBy(*area).agg(F.min("region").alias("region"))
    return areas.select(
        surrogate_key(*area).alias("geography_sk"), "postal_code", "municipality", "region", "country"
    )


def current(dim: DataFrame) -> DataFrame:
    """Only the open version of each key."""
    return dim.filter("is_current")


# --- facts ----------------------------------------------------------------------------

def _calendar(facts: DataFrame, dates: DataFrame, day: Column, name: str) -> DataFrame:
    return lookup(facts, dates, day, "full_date", {"date_key": name}, small=True)


def _key(facts: DataFrame, dim: DataFrame, natural: str, key: str) -> DataFrame:
    return lookup(facts, dim, natural, natural, {key: key})


def _found(facts: DataFrame, dim: DataFrame, natural: str, **take: str) -> DataFrame:
    """What the key of the dimension row is made of, NULL where there is no such row: the natural key as
    ``_<natural>`` and, of a version, its start. A few bytes travel in place of 32 digits."""
    if "valid_from" in dim.columns:
        take = {"valid_from": f"_{natural}_from", **take}
    return lookup(facts, dim, natural, natural, {natural: f"_{natural}", **take})


def _made(natural: str, versioned: bool = False) -> Column:
    """The key of the dimension row that `_found` has found."""
    parts = (f"_{natural}", f"_{natural}_from") if versioned else (f"_{natural}",)
    return F.when(F.col(f"_{natural}").isNotNull(), surrogate_key(*parts))


def invoice_facts(
    line_items: DataFrame, invoices: DataFrame, customers: DataFrame, households: DataFrame,
    products: DataFrame, contracts: DataFrame, dates: DataFrame, in_buckets: bool = False,
) -> DataFrame:
    """The rows of `fct_invoices` before what `invoice_keys` makes of them.

    What hangs on the invoice is looked up per invoice. Lines are shuffled to their product and then to
    their invoice, so that what the invoice brings travels no further than to its folder, and there next
    to the invoice's other lines, which costs little once compressed. Lines that lie ``in_buckets`` of
    the invoice meet it there first, and are shuffled to their product only.
    """
    header = invoices.select(
        "invoice_id", "customer_id", "household_id", "contract_id", "invoice_date",
        F.col("status").alias("invoice_status"),
    )
    header = _found(header, current(customers), "customer_id")
    header = _found(header, households, "household_id")
    header = _found(header, current(contracts), "contract_id")
    header = _calendar(header, dates, F.col("invoice_date"), "invoice_date_key").drop(
        "customer_id", "household_id", "contract_id", "invoice_date"
    )
    lines = invoice_lines(line_items)
    if in_buckets:
        lines = lines.join(header, "invoice_id")
    lines = _found(lines, products, "product_id", category="product_category").drop("product_id")
    return lines if in_buckets else lines.join(header, "invoice_id")


def invoice_keys() -> dict[str, Column]:
    return {
        "invoice_line_sk": surrogate_key("line_item_id"),
        "customer_sk": _made("customer_id", versioned=True),
        "household_sk": _made("household_id"),
        "product_sk": _made("product_id"),
        "contract_sk": _made("contract_id", versioned=True),
        **revenue(),
    }


def fct_invoices(*inputs: DataFrame, in_buckets: bool = False) -> DataFrame:
    """One row per invoice line with five dimension keys (C17), of the inputs of `invoice_facts`."""
    return invoice_facts(*inputs, in_buckets=in_buckets).withColumns(invoice_keys()).select(
        "invoice_line_sk",
        "line_item_id", "invoice_id", "customer_sk", "household_sk", "product_sk", "contract_sk",
        "invoice_date_key", "line_description", "quantity", "unit_price", "amount", "tax_amount",
        "net_amount", "invoice_status", "product_category", "revenue_classification",
    )


def payment_facts(
    payments: DataFrame, invoices: DataFrame, customers: DataFrame, households: DataFrame,
    contracts: DataFrame, dates: DataFrame, in_buckets: bool = False,
) -> DataFrame:
    """The rows of `fct_payments` before what `payment_keys` makes of them.

    Household and contract are looked up per invoice, of which there are fewer. Payments are shuffled to
    their customer and then to their invoice; those that lie ``in_buckets`` of the invoice meet it there
    first, and are shuffled to their customer only.
    """
    header = invoices.select("invoice_id", "household_id", "contract_id", "due_date")
    header = _found(header, households, "household_id")
    header = _found(header, current(contracts), "contract_id")
    facts = payments.select(
        "payment_id", "invoice_id", "customer_id", "payment_date", "payment_amount", "payment_method",
        F.col("status").alias("payment_status"),
    )
    taken = {c: c for c in header.columns if c.startswith("_")} | {"due_date": "due_date"}
    late = F.coalesce(F.col("payment_date") > F.col("due_date"), F.lit(False))

    def with_invoice(rows: DataFrame) -> DataFrame:
        met = lookup(rows, header, "invoice_id", "invoice_id", taken)
        return met.withColumn("is_late_payment", late).drop("due_date")

    if in_buckets:
        facts = with_invoice(facts)
    facts = _found(facts, current(customers), "customer_id").drop("customer_id")
    if not in_buckets:
        facts = with_invoice(facts)
    return _calendar(facts, dates, F.col("payment_date"), "payment_date_key").drop("payment_date")


def payment_keys() -> dict[str, Column]:
    return {
        "payment_sk": surrogate_key("payment_id"),
        "customer_sk": _made("customer_id", versioned=True),
        "household_sk": _made("household_id"),
        "contract_sk": _made("contract_id", versioned=True),
    }


def fct_payments(*inputs: DataFrame, in_buckets: bool = False) -> DataFrame:
    """One row per payment; late if paid after the due date, not late if either is unknown (C18); of the
    inputs of `payment_facts`."""
    return payment_facts(*inputs, in_buckets=in_buckets).withColumns(payment_keys()).select(
        "payment_sk",
        "payment_id", "invoice_id", "customer_sk", "household_sk", "contract_sk",
        "payment_date_key", "payment_amount", "payment_method", "payment_status", "is_late_payment",
    )


def fct_contract_lifecycle(
    contracts: DataFrame, customers: DataFrame, households: DataFrame, products: DataFrame,
    contract_versions: DataFrame, dates: DataFrame, as_of: Column,
) -> DataFrame:
    """One row per contract with its milestones; an open contract runs until ``as_of``."""
    facts = _key(contracts, current(customers), "customer_id", "customer_sk")
    facts = _key(facts, households, "household_id", "household_sk")
    facts = _key(facts, products, "product_id", "product_sk")
    facts = _key(facts, current(contract_versions), "contract_id", "contract_sk")
    facts = _calendar(facts, dates, F.col("start_date"), "start_date_key")
    facts = _calendar(facts, dates, F.col("end_date"), "end_date_key")
    status = F.col("status")
    return facts.select(
        surrogate_key("contract_id").alias("contract_lifecycle_sk"),
        "contract_id", "customer_sk", "household_sk", "product_sk", "contract_sk",
        "start_date_key", "end_date_key", "contract_type", "status", "created_at",
        F.col("created_at").alias("created_at_milestone"),
        F.when(status.isin(*STARTED), F.col("start_date")).alias("activated_at"),
        F.when(status == "renewed", F.col("updated_at")).alias("renewed_at"),
        F.when(status == "cancelled", F.col("updated_at")).alias("cancelled_at"),
        F.datediff(F.coalesce("end_date", F.to_date(as_of)), "start_date").alias("contract_duration_days"),
        "monthly_amount",
    )


def all_events(
    energy: DataFrame, temperature: DataFrame, status: DataFrame, alerts: DataFrame
) -> DataFrame:
    """The four event types as one stream; status events carry no value."""
    def branch(df: DataFrame, event_type: str, value: Column) -> DataFrame:
        return df.select(
            "device_id", "event_timestamp", F.lit(event_type).alias("event_type"),
            value.cast(READING).alias("reading_value"),
        )

    return (
        branch(energy, "energy_reading", F.col("kwh_reading"))
        .unionByName(branch(temperature, "temperature_reading", F.col("temperature_celsius")))
        .unionByName(branch(status, "device_status", F.lit(None)))
        .unionByName(branch(alerts, "alert_event", F.col("actual_value")))
    )


def staged_events(staged: DataFrame) -> DataFrame:
    """The same stream out of `staging.telemetry_all`, which has read the raw events once."""
    value = F.coalesce(*[F.col(c).cast(READING) for c in ("kwh_reading", "temperature_celsius", "actual_value")])
    return staged.select("device_id", "event_timestamp", "event_type", value.alias("reading_value"))


def device_homes(
    devices: DataFrame, households: DataFrame, customers: DataFrame | None = None
) -> DataFrame:
    """Per device, as telemetry names it: the keys of the device, its household, its customer.

    Joined among dimensions, so that events and readings need one lookup instead of three.
    Each dimension is held to one row per natural key (J9).
    """
    homes = one_per_key(
        devices.select(F.col("device_id").cast("string").alias("_device"), "device_sk", "household_id"),
        "_device", "device_sk",
    )
    places = one_per_key(households, "household_id", "household_sk")
    if customers is None:
        return lookup(homes, places, "household_id", "household_id", {"household_sk": "household_sk"})
    homes = lookup(
        homes, places, "household_id", "household_id",
        {"household_sk": "household_sk", "customer_id": "customer_id"},
    )
    return _key(homes, current(customers), "customer_id", "customer_sk")


def fct_device_telemetry(
    events: DataFrame, devices: DataFrame, households: DataFrame, dates: DataFrame,
    times: DataFrame, unique_events: bool = True, time_of: str = "clock",
) -> DataFrame:
    """One row per event with device, household, day and minute keys (C20).

    ``unique_events`` says that (device, time, type) occurs once, as staging leaves it;
    the ordinal inside the key is then 1 and costs nothing. Otherwise occurrences are
    numbered by value, over groups of any size.
    ``time_of="minute"`` looks minutes up by hour * 60 + minute instead of by clock time.
    """
    value_order = F.coalesce("reading_value", F.lit(NULL_READING_ORDER)).cast("decimal(14,4)")
    if unique_events:
        events = events.withColumn("_ordinal", F.lit(1))
    else:
        events = occurrence_ordinal(
            events.withColumn("_order", value_order),
            ["device_id", "event_timestamp", "event_type"], ["_order"], "_ordinal",
        ).drop("_order")
    facts = lookup(
        events, device_homes(devices, households), "device_id", "_device",
        {"device_sk": "device_sk", "household_sk": "household_sk"},
    )
    moment = F.col("event_timestamp")
    facts = _calendar(facts, one_per_key(dates, "full_date", "date_key"), F.to_date(moment), "date_key")
    minute = clock_key(moment) if time_of == "clock" else minute_of_day(moment)
    facts = lookup(facts, one_per_key(times, "time_key", "time_key"), minute, "time_key", {"time_key": "time_key"}, small=True)
    return facts.select(
        surrogate_key(
            "device_id", "event_timestamp", "event_type",
            F.coalesce(F.col("reading_value").cast("string"), F.lit(NULL_READING)),
            F.col("_ordinal"),
        ).alias("telemetry_sk"),
        "device_sk", "household_sk", "date_key", "time_key", "device_id", "event_timestamp",
        "event_type", "reading_value",
    )


def fct_energy_usage_daily(
    daily: DataFrame, devices: DataFrame, households: DataFrame, customers: DataFrame, dates: DataFrame
) -> DataFrame:
    """One row per device-day (C21). Its key hashes the fact's own device id, so unknown
    devices keep distinct keys."""
    facts = lookup(
        daily, device_homes(devices, households, customers), "device_id", "_device",
        {"device_sk": "device_sk", "household_sk": "household_sk", "customer_sk": "customer_sk"},
    )
    facts = _calendar(facts, dates, F.col("reading_date"), "date_key")
    return facts.select(
        surrogate_key("device_id", "reading_date").alias("energy_usage_daily_sk"),
        "device_sk", "household_sk", "customer_sk", "date_key", "device_id", "reading_date",
        "total_kwh", "peak_kwh", "avg_temperature", F.col("total_reading_count").alias("reading_count"),
    )


def fct_service_ticket_lifecycle(tickets: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per ticket."""
    facts = _calendar(tickets, dates, F.col("opened_at"), "opened_date_key")
    facts = _calendar(facts, dates, F.col("closed_at"), "closed_date_key")
    return facts.select(
        surrogate_key("ticket_id").alias("service_ticket_sk"),
        "ticket_id", "opened_date_key", "closed_date_key", "subject", "ticket_status", "priority",
        "severity", "origin", "opened_at", "assigned_at", "first_response_at", "resolved_at",
        "closed_at", "time_to_assign_hours", "time_to_first_response_hours",
        "time_to_resolve_hours", "comment_count",
    )


# --- bridges --------------------------------------------------------------------------

def bridge_household_device(lifecycle: DataFrame, households: DataFrame, devices: DataFrame) -> DataFrame:
    """Which device is in which household, and until when."""
    placed = lifecycle.join(households.select("household_id", "household_sk"), "household_id")
    keyed = placed.join(devices.select("device_id", "device_sk"), "device_id")
    gone = F.when(F.col("lifecycle_state") == "decommissioned", F.col("updated_at"))
    return keyed.select(
        "household_sk", "device_sk", "device_id", "household_id",
        F.col("installed_at").alias("effective_from"), gone.alias("effective_to"),
    )


def bridge_service_ticket_customer(tickets: DataFrame, profile: DataFrame, customers: DataFrame) -> DataFrame:
    """Ticket-customer pairs through the contact, with weights that sum to 1 per ticket."""
    asked = tickets.filter(F.col("contact_id").isNotNull()).select("ticket_id", "contact_id")
    matches = (
        profile.filter(F.col("crm_contact_id").isNotNull())
        .select("crm_contact_id", "customer_id")
        .distinct()
        .join(current(customers).select("customer_id", "customer_sk"), "customer_id")
    )
    pairs = (
        asked.join(matches, F.col("contact_id") == F.col("crm_contact_id"))
        .select("ticket_id", "customer_sk", "customer_id")
        .distinct()
    )
    return equal_weights(pairs, "ticket_id").select(
        surrogate_key("ticket_id", "customer_sk").alias("service_ticket_customer_sk"),
        "ticket_id", "customer_sk", "customer_id", "allocation_pct",
    )


# --- profile --------------------------------------------------------------------------

def customer_360(
    profile: DataFrame, contracts: DataFrame, lifecycle: DataFrame, households: DataFrame,
    invoices: DataFrame, ticket_bridge: DataFrame, tickets: DataFrame,
) -> DataFrame:
    """Wide customer row: match, contracts, devices, invoices, tickets.

    Each source shrinks to one row per customer before it meets the profile, so no join
    multiplies rows and all of them share one hash partitioning on the customer.
    """
    by_contract = contracts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_contracts"),
        F.count_if(F.col("status") == "active").alias("active_contracts"),
    )
    # Devices shrink to their household before they travel to its customer.
    per_household = lifecycle.groupBy("household_id").agg(
        F.count_if(F.col("lifecycle_state") == "active").alias("_active"),
        F.count(F.lit(1)).alias("_all"),
    )
    by_device = (
        per_household.join(households.select("household_id", "customer_id"), "household_id")
        .groupBy("customer_id")
        .agg(F.sum("_active").alias("active_device_count"), F.sum("_all").alias("total_device_count"))
    )
    by_invoice = invoices.groupBy("customer_id").agg(
        F.sum("total_amount").alias("lifetime_invoice_total"),
        F.max("invoice_date").alias("last_invoice_date"),
    )
    by_ticket = (
        ticket_bridge.select("customer_id", "ticket_id")
        .join(tickets.select("ticket_id", "opened_at"), "ticket_id")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("ticket_id").alias("total_service_tickets"),
            F.max("opened_at").alias("last_ticket_date"),
        )
    )
    wide = profile
    for part in (by_contract, by_device, by_invoice, by_ticket):
        wide = wide.join(part, "customer_id", "left")

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    def moment(name: str) -> Column:
        return F.coalesce(F.col(name).cast("timestamp_ntz"), F.lit(BEGINNING_OF_TIME).cast("timestamp_ntz"))

    return wide.select(
        surrogate_key("customer_id").alias("customer_360_sk"),
        "customer_id", F.col("oltp_email").alias("email"), "first_name", "last_name", "phone",
        "address", "postal_code", "municipality", "region", "country", "segment", "status",
        "match_status", "crm_contact_id", "crm_account_name", "crm_title", "crm_department",
        or_zero("total_contracts"), or_zero("active_contracts"), or_zero("active_device_count"),
        or_zero("total_device_count"), or_zero("lifetime_invoice_total"),
        or_zero("total_service_tickets"),
        F.greatest(moment("last_invoice_date"), moment("last_ticket_date"), moment("updated_at")).alias("last_interaction_date"),
        "created_at", "updated_at",
    )
