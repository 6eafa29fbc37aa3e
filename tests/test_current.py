"""Current state: ranking order, deletes, missing flags, hot keys."""

from datetime import date, datetime

from pyspark.sql import functions as F

from gridmart.operators.current import (
    cdc_current,
    latest_effective,
    latest_per_key,
    newest_first,
    saas_current,
    saas_filtered,
    telemetry_stage,
)

LOG = "_op string, _source_ts timestamp_ntz, _loaded_at timestamp_ntz, _connector_batch_id string, k bigint, v string"


def at(hour, minute=0):
    return datetime(2025, 1, 1, hour, minute)


def log(spark):
    return spark.createDataFrame(
        [
            ("INSERT", at(1), at(2), "b1", 1, "old"),
            ("UPDATE", at(3), at(4), "b2", 1, "new"),
            ("INSERT", at(1), at(2), "b1", 2, "before delete"),
            ("DELETE", at(5), at(6), "b3", 2, "gone"),
            ("INSERT", at(1), at(2), "b1", 3, "tie a"),
            ("UPDATE", at(1), at(2), "b2", 3, "tie b"),
            (None, at(9), at(9), "b9", 4, "no operation"),
            ("DELETE", at(9), at(9), "b9", 5, "only a delete"),
        ],
        LOG,
    )


def test_deletes_are_skipped_before_ranking(spark, rows):
    assert rows(cdc_current(log(spark), "k"), "k", "v") == [(1, "new"), (2, "before delete"), (3, "tie b")]


def test_deleted_keys_can_be_dropped(spark, rows):
    assert rows(cdc_current(log(spark), "k", drop_deleted=True), "k", "v") == [(1, "new"), (3, "tie b")]


def test_sync_rows_without_flag_are_dropped(spark, rows):
    sync = spark.createDataFrame(
        [
            (at(1), "s1", False, "a", date(2025, 1, 1), "first"),
            (at(2), "s2", False, "a", None, "no date"),
            (at(3), "s3", True, "a", date(2025, 2, 1), "deleted"),
            (at(3), "s3", None, "b", date(2025, 2, 1), "no flag"),
        ],
        "_loaded_at timestamp_ntz, _sync_id string, _is_deleted boolean, k string, last_modified_date date, v string",
    )
    assert rows(saas_current(sync, "k"), "k", "v") == [("a", "first")]
    assert saas_filtered(sync).count() == 2


def test_latest_effective(spark, rows):
    feed = spark.createDataFrame(
        [(1, date(2025, 1, 1), "old"), (1, date(2025, 3, 1), "new"), (2, date(2024, 1, 1), "only")],
        "k bigint, effective_date date, v string",
    )
    assert rows(latest_effective(feed, "k"), "k", "v") == [(1, "new"), (2, "only")]


def test_rank_limit_is_planned_before_the_shuffle(spark):
    plan = latest_per_key(log(spark), ["k"], newest_first("_source_ts"))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_telemetry_keeps_the_latest_load_and_survives_bad_payloads(spark, rows):
    def event(device, loaded, payload, kind="energy_reading"):
        return (device, kind, at(8), loaded, date(2025, 1, 1), payload)

    raw = spark.createDataFrame(
        [
            event("d1", at(9), '{"payload": {"kwh": 1.5}}'),
            event("d1", at(10), '{"payload": {"kwh": 2.5}}'),
            event("d2", at(9), '{"payload": {"kwh": "not a number"}}'),
            event("d3", at(9), '{"payload": null}'),
            event("d4", at(9), '{"payload": {"kwh": 9}}', "alert_event"),
        ],
        "device_id string, event_type string, event_timestamp timestamp_ntz, _loaded_at timestamp_ntz, _ingestion_date date, event_data string",
    )
    fields = {"kwh": ("kwh", "decimal(12,4)")}
    variant = raw.withColumn("event_data", F.parse_json("event_data"))
    for events in (raw, variant):
        staged = telemetry_stage(events, "energy_reading", fields).withColumn("kwh", F.col("kwh").cast("double"))
        assert rows(staged, "device_id", "kwh") == [("d1", 2.5), ("d2", None), ("d3", None)]
    later = telemetry_stage(raw, "energy_reading", fields, loaded_from=F.lit(at(10)).cast("timestamp_ntz"))
    assert later.count() == 1
