"""Data-quality checks (D1-D14). Each returns the failing rows; empty means passed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import boundaries_between
from .joins import not_in
from .scd2 import scd2_overlapping_versions

# Accepted codes, thresholds and freshness limits.
CONTRACT_STATUSES = ("active", "renewed", "cancelled", "expired", "suspended", "service_agreement")
MATCH_STATUSES = ("matched", "oltp_only", "crm_only")
LIFECYCLE_STATES = ("provisioned", "active", "degraded", "inactive", "decommissioned")
EVENT_TYPES = ("energy_reading", "temperature_reading", "device_status", "alert_event")
VOLUME_THRESHOLD = 0.30
VOLUME_MIN_DAYS = 3
PLAUSIBLE_CELSIUS = (-50, 80)
FRESHNESS_MINUTES = {
    "oltp": (30, 60),
    "crm": (90, 180),
    "iot": (10, 30),
    "partner_feeds": (36 * 60, 72 * 60),
}


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-NULL values with their row counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child keys without a parent, one row per child row."""
    keys = parent.select(F.col(field).alias("_parent_key")).filter(F.col("_parent_key").isNotNull())
    return (
        df.select(F.col(column).alias("orphan_key"))
        .filter(F.col("orphan_key").isNotNull())
        .join(keys, F.col("orphan_key") == F.col("_parent_key"), "left_anti")
    )


def referential_integrity(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """As `relationships`, but with NOT IN semantics: a NULL parent key hides all orphans."""
    return not_in(df.select(F.col(column).alias("orphan_key")), "orphan_key", parent, field)


def surrogate_key_collision(df: DataFrame, key: str, natural: Sequence[str]) -> DataFrame:
    """Surrogate keys shared by several natural keys.

    A natural key with a NULL part is not counted, since its joined text is NULL.
    """
    parts: list[Column] = []
    for name in natural:
        parts += [F.col(name).cast("string"), F.lit("|")]
    return (
        df.groupBy(F.col(key).alias("surrogate_key"))
        .agg(F.count_distinct(F.concat(*parts[:-1])).alias("distinct_natural_keys"))
        .filter("distinct_natural_keys > 1")
    )


def scd2_no_overlap(
    df: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """Versions that start before an earlier one of their key has ended (D7), one row each."""
    return scd2_overlapping_versions(df, key, valid_from, valid_to)


def volume_anomaly(
    history: DataFrame,
    as_of: Column,
    threshold: float = VOLUME_THRESHOLD,
    min_days: int = VOLUME_MIN_DAYS,
) -> DataFrame:
    """Models whose row count on ``as_of`` strays from the mean of the seven days before.

    ``history``: model_name, row_count, measured_at.
    """
    day = F.to_date("measured_at")
    past = (
        history.filter((day < as_of) & (day >= F.date_sub(as_of, 7)))
        .groupBy("model_name")
        .agg(
            F.avg(F.col("row_count").cast("double")).alias("avg_row_count"),
            F.count(F.lit(1)).alias("_days"),
        )
        .filter(F.col("_days") >= min_days)
        .drop("_days")
    )
    latest = history.filter(day == as_of).select(
        "model_name", F.col("row_count").alias("latest_row_count")
    )
    deviation = F.try_divide(
        F.abs(F.col("latest_row_count") - F.col("avg_row_count")), F.col("avg_row_count")
    )
    return (
        latest.join(past, "model_name")
        .withColumn("deviation_pct", deviation)
        .filter(F.col("deviation_pct") > threshold)
    )


def freshness(
    df: DataFrame, source: str, as_of: Column, loaded_at: str = "_loaded_at"
) -> DataFrame:
    """One row: age of the newest load in minutes and pass / warn / error."""
    warn, error = FRESHNESS_MINUTES[source]
    age = boundaries_between("minute", F.col("max_loaded_at"), as_of)
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("age_minutes", age)
        .select(
            F.lit(source).alias("source"),
            "max_loaded_at",
            "age_minutes",
            F.when(F.col("age_minutes").isNull() | (F.col("age_minutes") > error), "error")
            .when(F.col("age_minutes") > warn, "warn")
            .otherwise("pass")
            .alias("state"),
        )
    )


def broken_rules(df: DataFrame, rules: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row per rule a row breaks: ``failure_reason`` plus ``keys``.

    All rules are tested in one scan; a row breaking two rules is reported twice.
    """
    reasons = F.array_compact(
        F.array(*[F.when(broken, F.lit(reason)) for reason, broken in rules.items()])
    )
    return df.select(F.explode(reasons).alias("failure_reason"), *keys)


def contract_status_rules(contracts: DataFrame) -> DataFrame:
    """Known status, end date when over, start date when active, sane timestamps."""
    status = F.col("status")
    return broken_rules(
        contracts,
        {
            "invalid_status": ~status.isin(*CONTRACT_STATUSES),
            "terminal_missing_end_date": status.isin("cancelled", "expired")
            & F.col("end_date").isNull(),
            "active_missing_start_date": (status == "active") & F.col("start_date").isNull(),
            "updated_before_created": F.col("updated_at") < F.col("created_at"),
        },
        ["contract_id"],
    )


def entity_match_rules(profile: DataFrame) -> DataFrame:
    """Known match status, and a contact exactly where one is claimed."""
    status, contact = F.col("match_status"), F.col("crm_contact_id")
    return broken_rules(
        profile,
        {
            "invalid_match_status": ~status.isin(*MATCH_STATUSES),
            "matched_without_crm_contact": (status == "matched") & contact.isNull(),
            "oltp_only_has_crm_contact": (status == "oltp_only") & contact.isNotNull(),
        },
        ["customer_id"],
    )


def daily_rollup_rules(daily: DataFrame) -> DataFrame:
    """Sum not below maximum, readings present, plausible mean, one row per device-day."""
    low, high = PLAUSIBLE_CELSIUS
    mean = F.col("avg_temperature")
    keys = ["device_id", "reading_date"]
    per_row = broken_rules(
        daily,
        {
            "total_kwh_less_than_peak": F.col("total_kwh") < F.col("peak_kwh"),
            "zero_reading_count": F.col("total_reading_count") <= 0,
            "implausible_temperature": (mean < low) | (mean > high),
        },
        keys,
    )
    repeated = (
        daily.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
        .select(F.lit("duplicate_grain").alias("failure_reason"), *keys)
    )
    return per_row.unionByName(repeated)


@dataclass(frozen=True)
class Mismatch:
    column: str
    expected: str | None
    actual: str | None


def schema_mismatches(df: DataFrame, declared: str) -> list[Mismatch]:
    """Columns whose name or type differs from the declared DDL (D13). Order does not matter."""
    wanted = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(declared)}
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    return [
        Mismatch(name, wanted.get(name), found.get(name))
        for name in dict.fromkeys([*wanted, *found])
        if wanted.get(name) != found.get(name)
    ]


def enforce_contract(df: DataFrame, declared: str) -> DataFrame:
    """``df`` in declared column order, or a ValueError naming every difference."""
    wrong = schema_mismatches(df, declared)
    if wrong:
        text = "; ".join(f"{m.column}: declared {m.expected}, found {m.actual}" for m in wrong)
        raise ValueError(f"schema contract broken: {text}")
    return df.select(*StructType.fromDDL(declared).names)


def tag_pii(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mark columns as personal data in the schema (D14); Parquet keeps the mark."""
    for name in columns:
        df = df.withMetadata(name, {"classification": "PII"})
    return df


def pii_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.metadata.get("classification") == "PII"]
