"""Current state out of change logs, sync tables and event streams.

`latest_per_key` filters ``row_number() = 1``; Spark plans that as a rank limit on both
sides of the shuffle, so each map task sends at most one row per key and a hot key
costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import payload_field


def latest_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]
) -> DataFrame:
    """The first row of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def cdc_current(
    log: DataFrame,
    key: str,
    ts: str = "_source_ts",
    op: str = "_op",
    tie_break: Sequence[str] = ("_loaded_at", "_connector_batch_id"),
    drop_deleted: bool = False,
) -> DataFrame:
    """One row per key: its latest change.

    Delete rows are skipped *before* ranking, so a deleted key keeps its last earlier
    version. ``drop_deleted=True`` ranks first, which makes deleted keys disappear.
    """
    order = newest_first(ts, *[c for c in tie_break if c in log.columns])
    live = F.col(op) != "DELETE"
    if drop_deleted:
        return latest_per_key(log, [key], order).filter(live)
    return latest_per_key(log.filter(live), [key], order)


def saas_filtered(sync: DataFrame) -> DataFrame:
    """Rows not flagged as deleted; a missing flag counts as deleted."""
    return sync.filter(~F.col("_is_deleted"))


def saas_current(
    sync: DataFrame,
    key: str,
    order: Sequence[str] = ("last_modified_date", "_loaded_at", "_sync_id"),
) -> DataFrame:
    """Latest undeleted sync row per key."""
    return latest_per_key(saas_filtered(sync), [key], newest_first(*order))


def telemetry_stage(
    events: DataFrame,
    event_type: str,
    fields: Mapping[str, tuple[str, str]],
    loaded_from: Column | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One event type as a typed table, one row per device and event time (C4).

    ``fields`` maps output names to (payload field, type). Fields are taken out of the
    payload before the shuffle, so the payload itself never travels. ``loaded_from``
    is the high-water mark of an incremental run.
    """
    wanted = events.filter(F.col("event_type") == event_type)
    if loaded_from is not None:
        wanted = wanted.filter(F.col("_loaded_at") >= loaded_from)
    typed = wanted.select(
        "device_id",
        "event_timestamp",
        *[
            payload_field(events, "event_data", f"$.payload.{source}", data_type).alias(name)
            for name, (source, data_type) in fields.items()
        ],
        "_loaded_at",
        "_ingestion_date",
    )
    # Rows loaded at the same instant are told apart by their content.
    order = newest_first("_loaded_at", *(tie_break or fields))
    return latest_per_key(typed, ["device_id", "event_timestamp"], order)


def latest_effective(
    df: DataFrame,
    key: str,
    effective: str = "effective_date",
    tie_break: Sequence[str] = ("_loaded_at", "_source_file_name", "_source_file_row_number"),
) -> DataFrame:
    """Newest row per key by business date."""
    order = newest_first(effective, *[c for c in tie_break if c in df.columns])
    return latest_per_key(df, [key], order)
