"""Streams over files that Spark writes from the driver's tables, run until drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmart.plans import staging
from gridmart.plans.warehouse import Warehouse
from gridmart.session import scratch_path
from gridmart.sources.schemas import PAYLOADS
from gridmart.streaming import progress, sources, upserts

from . import domain
from .model_queries import STATUS_AS_OF, STATUS_SQL
from .oracle import sk
from .registry import add

BATCHES = 3
# Buckets of the stream-kept tables here; a cluster keeps the default.
BUCKETS = 8


def stream(spark, sf, feed, order, batches=BATCHES, late=None, stamped=False):
    """A feed as a stream of several batches, written one after the other in its own order.

    ``late`` is a condition on rows that arrive five hours after their order says, and after
    rows of later batches with it; ``stamped`` rows carry that as their order.
    """
    path = scratch_path(spark, f"stream-{feed}")
    rows = domain.RawFeeds(spark, sf)[feed]
    schema = rows.schema
    if feed == "telemetry_events":
        rows = rows.withColumn("event_data", F.to_json("event_data"))
        schema = rows.schema
    moment = F.col(order)
    if late is not None:
        moment = F.when(F.expr(late), moment + F.expr("INTERVAL 5 HOURS")).otherwise(moment)
    rows = rows.withColumn("_moment", moment)
    if stamped:
        rows = rows.withColumn(order, moment)
    first, last = rows.agg(F.min("_moment"), F.max("_moment")).first()
    cuts = [first + (last - first) * i / batches for i in range(1, batches)]
    part = sum([(F.col("_moment") > F.lit(c).cast("timestamp_ntz")).cast("int") for c in cuts], F.lit(0))
    files = [0]
    for i in range(batches):
        rows.filter(part == i).drop("_moment").write.mode("append").parquet(path)
        files.append(len(spark.read.schema(schema).parquet(path).inputFiles()))
    # Older files are read first. A write leaves more files the more rows it has; a trigger takes as many
    # as the largest write left, so there are never more batches than writes.
    most = max(after - before for before, after in zip(files, files[1:]))
    incoming = sources.table_stream(spark, path, schema, files_per_trigger=max(1, most))
    if feed == "telemetry_events":
        incoming = incoming.withColumn("event_data", F.parse_json("event_data"))
    return incoming


def drained(query):
    query.awaitTermination()


def s10(spark, sf):
    lines, out = scratch_path(spark, "event-lines"), scratch_path(spark, "events-out")
    readings = domain.run_sql(spark, sf, domain.RAW_SQL["telemetry_readings"])
    domain.event_json(readings).select("event_json").write.text(lines)
    events = sources.event_lines(spark, lines, files_per_trigger=1)
    drained(
        events.select("device_id", "event_type", "event_timestamp")
        .writeStream.option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out, format="parquet")
    )
    return spark.read.parquet(out)


add("s10_streaming_source", s10, "SELECT device_id, event_type, event_timestamp FROM raw_telemetry_readings")


def t1(spark, sf):
    table, checkpoint = scratch_path(spark, "t1"), scratch_path(spark, "checkpoint")
    raw = stream(spark, sf, "telemetry_events", "_loaded_at")
    fields = PAYLOADS["alert_event"]
    drained(upserts.append_new_events(raw, "alert_event", fields, table, checkpoint))
    return upserts.new_events(spark, table, fields).drop("event_date")


add("t1_incremental_append_stream", t1, "SELECT * FROM stg_iot__alert_events", "threshold_value actual_value")


def t1_batch(spark, sf):
    """Two builds: the second reads from the newest load of the first on, that instant included."""
    root = scratch_path(spark, "t1-builds")
    events = domain.RawFeeds(spark, sf)["telemetry_events"]
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    before = events.filter(F.col("_loaded_at") <= mark)
    Warehouse(spark, {"telemetry_events": before}).load_telemetry(root)
    staged = Warehouse(spark, {"telemetry_events": events}).load_telemetry(root)
    return staging.telemetry_of(staged, "alert_events")


add("t1_high_water_mark", t1_batch, "SELECT * FROM stg_iot__alert_events", "threshold_value actual_value")


LATE_EVENTS = "pmod(xxhash64(device_id, event_timestamp), 40) = 0"


def t2_first(batches):
    def query(spark, sf):
        table, checkpoint = scratch_path(spark, "t2"), scratch_path(spark, "checkpoint")
        raw = stream(spark, sf, "telemetry_events", "_loaded_at", batches, LATE_EVENTS, stamped=True)
        for part in upserts.first_of_late_events(raw, table, checkpoint):
            drained(part)
        return upserts.first_events(spark, table).select("device_id", "event_type", "event_timestamp")

    return query


# Which delivery is kept depends on arrival; that exactly one is kept, however late, does not.
for name, batches in (("t2_first_of_late_events", BATCHES), ("t2_first_of_late_events_in_one_batch", 1)):
    add(name, t2_first(batches),
        "SELECT DISTINCT device_id, event_type, event_timestamp FROM raw_telemetry_readings")


def t2_latest(spark, sf):
    table, checkpoint = scratch_path(spark, "t2"), scratch_path(spark, "checkpoint")
    raw = stream(spark, sf, "telemetry_events", "_loaded_at", late=LATE_EVENTS)
    fields = PAYLOADS["energy_reading"]
    drained(upserts.keep_latest_events(raw, "energy_reading", fields, table, checkpoint))
    return upserts.latest_events(spark, table, fields).drop("event_date")


add("t2_keep_latest_events", t2_latest, "SELECT * FROM stg_iot__energy_readings", "kwh_reading voltage current_amps")


def t3(spark, sf):
    table, checkpoint = scratch_path(spark, "t3"), scratch_path(spark, "checkpoint")
    raw = stream(spark, sf, "telemetry_events", "_loaded_at")
    drained(upserts.maintain_latest_status(raw, table, checkpoint))
    as_of = F.lit(STATUS_AS_OF).cast("timestamp_ntz")
    return upserts.status_at(spark, table, as_of).drop("latest_event_data")


add("t3_latest_status_stream", t3, STATUS_SQL)


def t4(spark, sf):
    table, checkpoint = scratch_path(spark, "t4"), scratch_path(spark, "checkpoint")
    log = stream(spark, sf, "customers", "_source_ts")
    drained(upserts.maintain_current_state(log, "customer_id", table, checkpoint))
    state = upserts.current_state(spark, table, "customer_id")
    return state.select("customer_id", "status", "_source_ts", "updated_at")


add("t4_current_state_stream", t4, "SELECT customer_id, status, _source_ts, updated_at FROM stg_oltp__customers")

LATE_CHANGES = "pmod(xxhash64(customer_id, _source_ts), 5) = 0"


def t5(batches):
    def query(spark, sf):
        """Several changes of a key in one batch, and changes that come after later ones."""
        table, checkpoint = scratch_path(spark, "t5"), scratch_path(spark, "checkpoint")
        log = stream(spark, sf, "customers", "_source_ts", batches, LATE_CHANGES)
        drained(upserts.maintain_versions(log, "customer_id", table, checkpoint, buckets=BUCKETS))
        return upserts.versions(spark, table).select(
            "customer_id", "status", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to"
        )

    return query


for name, batches in (("t5_versions_stream", BATCHES), ("t5_versions_stream_in_one_batch", 1)):
    add(name, t5(batches), f"""
SELECT customer_id, status, {sk('customer_id', 'updated_at')} AS dbt_scd_id, updated_at AS dbt_valid_from,
    lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS dbt_valid_to
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at
    ORDER BY _source_ts DESC, _loaded_at DESC, _connector_batch_id DESC) AS rn
    FROM raw_customers WHERE _op <> 'DELETE') WHERE rn = 1""")


def t6(spark, sf):
    """Age of what a stream has worked off so far, by its own reports, against the limits of its source."""
    reports = scratch_path(spark, "progress")
    table, checkpoint = scratch_path(spark, "t6"), scratch_path(spark, "checkpoint")
    raw = stream(spark, sf, "telemetry_events", "_loaded_at")
    seen = progress.observed(raw.filter("event_type = 'device_status'"))
    log = progress.ProgressLog(spark, reports)
    spark.streams.addListener(log)
    try:
        query = upserts.append_new_events(seen, "device_status", PAYLOADS["device_status"], table, checkpoint)
        drained(query)
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    as_of = F.lit(STATUS_AS_OF).cast("timestamp_ntz")
    return progress.stream_freshness(progress.read_progress(spark, reports), "iot", as_of)


add("t6_freshness_lag", t6, f"""
SELECT 'iot' AS source, m AS max_loaded_at, minutes AS age_minutes,
    CASE WHEN minutes > 30 THEN 'error' WHEN minutes > 10 THEN 'warn' ELSE 'pass' END AS state
FROM (SELECT max(_loaded_at) AS m, date_diff('minute', max(_loaded_at), TIMESTAMP '{STATUS_AS_OF}') AS minutes
    FROM stg_iot__device_status)""")
