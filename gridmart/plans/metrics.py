"""Metrics outside the billing model (M7-M10) and those named without a formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper ends, in days overdue, of the payment-ageing buckets; our choice.
AGING_DAYS = (30, 60, 90)


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def average_daily_energy_consumption(usage: DataFrame) -> DataFrame:
    return usage.agg(
        F.avg(F.col("total_kwh").cast("double")).alias("average_daily_energy_consumption")
    )


def first_response_time(tickets: DataFrame) -> DataFrame:
    """The mean, although the metric goes by "median"; see `median_first_response_time`."""
    return tickets.agg(
        F.avg("time_to_first_response_hours").alias("average_first_response_time")
    )


def median_first_response_time(tickets: DataFrame) -> DataFrame:
    """Exact: what is kept per task is a count per distinct number of hours, not the rows."""
    return tickets.agg(
        F.median("time_to_first_response_hours").alias("median_first_response_time")
    )


def active_customer_count(profile: DataFrame) -> DataFrame:
    return profile.agg(F.count_if(F.col("status") == "active").alias("active_customer_count"))


def device_uptime_rate(profile: DataFrame) -> DataFrame:
    """Active devices out of all devices; the formula is ours."""
    return profile.agg(
        _ratio(F.sum("active_device_count"), F.sum("total_device_count")).alias("device_uptime_rate")
    )


def recurring_revenue(contracts: DataFrame) -> DataFrame:
    """MRR over active contracts, ARPU over the customers holding one."""
    return contracts.filter(F.col("status") == "active").agg(
        F.sum("monthly_amount").alias("mrr"),
        _ratio(F.sum("monthly_amount"), F.count_distinct("customer_id")).alias("arpu"),
    )


def churn_rate(profile: DataFrame) -> DataFrame:
    return profile.agg(
        _ratio(F.count_if(F.col("status") == "churned"), F.count(F.lit(1))).alias("churn_rate")
    )


def payment_aging(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Open invoice totals by days overdue."""
    overdue = F.datediff(as_of, F.col("due_date"))
    bucket = F.when(overdue <= 0, "not due")
    low = 1
    for high in AGING_DAYS:
        bucket = bucket.when(overdue <= high, f"{low}-{high} days")
        low = high + 1
    return (
        invoices.filter((F.col("status") != "paid") & F.col("due_date").isNotNull())
        .groupBy(bucket.otherwise(f"over {AGING_DAYS[-1]} days").alias("aging_bucket"))
        .agg(
            F.count(F.lit(1)).alias("open_invoices"),
            F.sum("total_amount").alias("open_amount"),
        )
    )


def alert_frequency(alerts: DataFrame) -> DataFrame:
    """Alerts per device and day."""
    return alerts.groupBy("device_id", F.to_date("event_timestamp").alias("alert_date")).agg(
        F.count(F.lit(1)).alias("alert_count")
    )


def fleet_status(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.groupBy("lifecycle_state").agg(F.count(F.lit(1)).alias("device_count"))


def firmware_currency(lifecycle: DataFrame) -> DataFrame:
    """Share of each model's devices on its newest firmware.

    Versions compare number by number, so 1.10 is newer than 1.9. Devices are counted per
    model and version first; what ranks versions has one row for each.
    """
    numbers = F.transform(F.split("firmware_version", r"\."), lambda part: part.try_cast("int"))
    per_version = lifecycle.groupBy("model", numbers.alias("_version")).agg(
        F.count(F.lit(1)).alias("_devices")
    )
    return per_version.groupBy("model").agg(
        F.sum("_devices").alias("device_count"),
        _ratio(F.max_by("_devices", "_version"), F.sum("_devices")).alias("firmware_currency"),
    )


def service_levels(tickets: DataFrame, resolve_within_hours: int = 72) -> DataFrame:
    """MTTR, share of escalated tickets, share resolved within the agreed time."""
    return tickets.agg(
        F.avg("time_to_resolve_hours").alias("mttr_hours"),
        _ratio(F.count_if(F.col("ticket_status") == "escalated"), F.count(F.lit(1))).alias("escalation_rate"),
        _ratio(
            F.count_if(F.col("time_to_resolve_hours") <= resolve_within_hours),
            F.count("time_to_resolve_hours"),
        ).alias("sla_rate"),
    )
