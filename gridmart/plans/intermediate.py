"""Enrichment between staging and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boundaries_between
from ..operators.current import latest_per_key, newest_first
from ..operators.joins import full_outer, lookup

# Product category -> revenue class, and the hours after which silence counts.
REVENUE_CLASSES = {
    "device": "hardware_revenue",
    "service": "service_revenue",
    "bundle": "bundle_revenue",
}
OTHER_REVENUE = "other_revenue"
SILENT_HOURS = 72


def invoice_lines(line_items: DataFrame) -> DataFrame:
    return line_items.select(
        "line_item_id", "invoice_id", "product_id", F.col("description").alias("line_description"),
        "quantity", "unit_price", "amount", "tax_amount",
    )


def revenue() -> dict[str, Column]:
    """Revenue class and net amount of lines that know their product category.

    ``net_amount`` subtracts the tax although the amount excludes it already; the rule is
    fixed by a unit test of the data model.
    """
    category = F.col("product_category")
    revenue_class = F.coalesce(
        *[F.when(category == c, name) for c, name in REVENUE_CLASSES.items()], F.lit(OTHER_REVENUE)
    )
    return {
        "revenue_classification": revenue_class,
        "net_amount": F.col("amount") - F.coalesce("tax_amount", F.lit(0)),
    }


def with_revenue(lines: DataFrame) -> DataFrame:
    return lines.withColumns(revenue())


def invoice_enriched(
    line_items: DataFrame, invoices: DataFrame, products: DataFrame, contracts: DataFrame
) -> DataFrame:
    """Line items with their invoice, product and contract.

    The contract is looked up once per invoice, before the lines multiply it.
    """
    header = lookup(
        invoices.select(
            "invoice_id", "customer_id", "household_id", "contract_id", "invoice_date", "due_date",
            F.col("status").alias("invoice_status"),
        ),
        contracts, "contract_id", "contract_id",
        {"contract_type": "contract_type", "tariff_plan_id": "tariff_plan_id"},
    )
    lines = lookup(
        invoice_lines(line_items).join(header, "invoice_id"), products, "product_id", "product_id",
        {"product_name": "product_name", "category": "product_category", "pricing_tier": "pricing_tier"},
    )
    return with_revenue(lines)


def best_contact_per_email(contacts: DataFrame) -> DataFrame:
    """The contact an email address stands for: newest change, newest creation, highest id."""
    keyed = contacts.withColumn("_email", F.lower("email")).filter(F.col("_email").isNotNull())
    return latest_per_key(
        keyed, ["_email"], newest_first("last_modified_date", "created_date", "contact_id")
    )


def unified_profile(
    customers: DataFrame, contacts: DataFrame, accounts: DataFrame, keep_crm_only: bool = False
) -> DataFrame:
    """Customers matched to one CRM contact by email.

    The best contact depends on contact columns alone, so it is chosen per email before
    the join. Ranking all customer-contact pairs afterwards gives the same rows, but
    multiplies the customers and the contacts of every shared address.
    ``keep_crm_only`` adds contacts no customer has the address of.
    """
    contact = lookup(
        best_contact_per_email(contacts).select(
            F.col("_email"),
            F.col("contact_id").alias("crm_contact_id"),
            F.col("account_id").alias("crm_account_id"),
            F.col("title").alias("crm_title"),
            F.col("department").alias("crm_department"),
        ),
        accounts, "crm_account_id", "account_id", {"account_name": "crm_account_name"},
    )
    people = customers.select(
        "customer_id", F.col("email").alias("oltp_email"), "first_name", "last_name", "phone",
        "address", "postal_code", "municipality", "region", "country", "segment", "status",
        "created_at", "updated_at",
    )
    same = F.lower("oltp_email") == F.col("_email")
    if keep_crm_only:
        # A full join would send all customers without an address to one task; they match
        # no one, so they go round it.
        matched = people.filter(F.col("oltp_email").isNotNull()).join(contact, same, "full")
        nobody = people.filter(F.col("oltp_email").isNull())
        matched = matched.unionByName(nobody, allowMissingColumns=True)
    else:
        matched = people.join(contact, same, "left")
    known, in_crm = F.col("customer_id").isNotNull(), F.col("crm_contact_id").isNotNull()
    status = F.when(known & in_crm, "matched").when(known, "oltp_only").otherwise("crm_only")
    return matched.drop("_email").withColumn("match_status", status)


def device_lifecycle(devices: DataFrame, device_status: DataFrame, as_of: Column) -> DataFrame:
    """Device master with a state from its own status and its last heartbeat.

    Device ids are numbers in the master and text in telemetry: the number is cast, since
    telemetry may carry ids that are none.
    """
    # Rows of one instant never differ in device and time, so content breaks ties.
    latest = latest_per_key(
        device_status, ["device_id"], newest_first("event_timestamp", "_loaded_at", "status")
    )
    joined = lookup(
        devices.select(
            "device_id", "device_serial", "household_id", "device_type", "manufacturer", "model",
            "firmware_version", "installed_at", F.col("status").alias("source_status"),
            "created_at", "updated_at",
        ),
        latest, F.col("device_id").cast("string"), "device_id",
        {"status": "latest_telemetry_status", "event_timestamp": "last_status_timestamp"},
    )
    heartbeat = F.col("latest_telemetry_status")
    silent = boundaries_between("hour", F.col("last_status_timestamp"), as_of) > SILENT_HOURS
    state = (
        F.when(F.col("source_status") == "decommissioned", "decommissioned")
        .when((heartbeat == "offline") & silent, "decommissioned")
        .when(heartbeat == "degraded", "degraded")
        .when(heartbeat == "offline", "inactive")
        .when(heartbeat == "online", "active")
        .when(F.col("installed_at").isNotNull() & (F.col("source_status") == "active"), "active")
        .otherwise("provisioned")
    )
    return joined.withColumn("lifecycle_state", state)


def telemetry_daily(energy: DataFrame, temperature: DataFrame) -> DataFrame:
    """Device-days: energy sum and peak, mean temperature, number of readings."""
    day = F.to_date("event_timestamp").alias("reading_date")
    by_energy = energy.groupBy("device_id", day).agg(
        F.sum("kwh_reading").alias("total_kwh"),
        F.max("kwh_reading").alias("peak_kwh"),
        F.count(F.lit(1)).alias("_energy"),
    )
    by_temperature = temperature.groupBy("device_id", day).agg(
        F.avg("temperature_celsius").alias("avg_temperature"),
        F.count(F.lit(1)).alias("_temperature"),
    )
    return (
        full_outer(by_energy, by_temperature, ["device_id", "reading_date"])
        .withColumn(
            "total_reading_count",
            F.coalesce("_energy", F.lit(0)) + F.coalesce("_temperature", F.lit(0)),
        )
        .drop("_energy", "_temperature")
    )


def ticket_enriched(cases: DataFrame, comments: DataFrame, contacts: DataFrame) -> DataFrame:
    """Tickets with milestones and durations in hours (C11).

    ``assigned_at`` is a placeholder, one day after opening, so its duration is always 24.
    """
    replies = comments.groupBy(F.col("case_id").alias("_case")).agg(
        F.min("created_date").alias("first_response_at"),
        F.count(F.lit(1)).alias("comment_count"),
    )
    tickets = cases.join(replies, F.col("case_id") == F.col("_case"), "left").drop("_case")
    tickets = lookup(tickets, contacts, "contact_id", "contact_id", {"email": "contact_email"})
    opened, assigned = F.col("opened_at"), F.col("assigned_at")
    return (
        tickets.withColumnsRenamed(
            {
                "case_id": "ticket_id",
                "status": "ticket_status",
                "created_date": "opened_at",
                "closed_date": "closed_at",
            }
        )
        .withColumn("assigned_at", F.date_add("opened_at", 1))
        .select(
            "ticket_id", "account_id", "contact_id", "contact_email", "subject", "description",
            "ticket_status", "priority", "severity", "origin", "opened_at", "assigned_at",
            "first_response_at",
            F.when(F.col("ticket_status") == "closed", F.col("closed_at")).alias("resolved_at"),
            "closed_at",
            boundaries_between("hour", opened, assigned).alias("time_to_assign_hours"),
            boundaries_between("hour", opened, F.col("first_response_at")).alias("time_to_first_response_hours"),
            boundaries_between("hour", opened, F.col("closed_at")).alias("time_to_resolve_hours"),
            "comment_count",
            "last_modified_date",
        )
    )
