"""What streams keep up to date (T1-T5), by Spark's own means over plain Parquet.

* Latest status (T3) and current state (T4) are streaming aggregates, ``max_by`` per key, in the RocksDB
  state store; every micro-batch writes the keys it changed.
* Incremental staging (T1) and late deliveries (T2) are stateless: a batch writes its own rows, and T1
  only those events that are not there yet.
* First of late events (T2) is ``dropDuplicatesWithinWatermark``; rows too late for it are split off
  before and folded in by the reading side.
* Versions (T5) rewrite the hash buckets that a batch touches.

A batch's rows go to a folder named after the stream (the id in its checkpoint) and the batch, in overwrite
mode: repeating a batch, as Spark does after a failure, writes the same files again. Readers fold the
folders, which is harmless to rows that are there twice; `gather` is the ordinary batch job that
now and then folds them into one. Each pair of functions is a writer, which starts a query, and a
reader. A writer's ``every`` is the trigger interval; None works off what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import surrogate_key
from ..operators.current import latest_per_key, newest_first, telemetry_stage
from ..operators.scd2 import scd2_from_log
from ..plans.serving import connectivity
from ..sources.sinks import read_if_exists, remove, replace_partitions

BUCKETS = 256
BUCKET = "bucket"
EVENT_DAY = "event_date"
EVENT = ("device_id", "event_timestamp")
ANY_EVENT = (*EVENT, "event_type")
TIE_BREAK = ("_loaded_at", "_connector_batch_id")
STREAM, BATCH = "stream", "batch"
GATHERED = "gathered"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

Fold = Callable[[DataFrame], DataFrame]


def folder(table: str, stream: str, batch: int) -> str:
    return f"{table.rstrip('/')}/{STREAM}={stream}/{BATCH}={batch}"


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def _each_batch(
    rows: DataFrame,
    checkpoint: str,
    every: str | None,
    write: Callable[[DataFrame, str, int], None],
    mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``write``, with the stream's id and the batch's number."""

    def each(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        write(batch, stream, number)

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    return writer.trigger(**_trigger(every)).start()


def _rows(spark: SparkSession, table: str) -> DataFrame | None:
    """All batches' rows; the day of an event as a date also where no batch has one."""
    found = read_if_exists(spark, table)
    if found is not None and EVENT_DAY in found.columns:
        found = found.withColumn(EVENT_DAY, F.col(EVENT_DAY).cast("date"))
    return found


def _folded(spark: SparkSession, table: str, fold: Fold) -> DataFrame | None:
    found = _rows(spark, table)
    return None if found is None else fold(found).drop(STREAM, BATCH)


def gather(spark: SparkSession, table: str, fold: Fold, partition: str | None = None) -> None:
    """Fold all batches so far into one folder, and remove theirs. An ordinary batch job, to be run while
    no reader is at work; a stream may go on, its new batches are not touched. If it dies before the
    end, rows are there twice, which folding undoes."""
    found = _rows(spark, table)
    if found is None:
        return
    old = found.select(STREAM, BATCH).distinct().collect()  # one row per batch since the last time
    number = max([r[BATCH] for r in old if r[STREAM] == GATHERED], default=-1) + 1
    rows = fold(found).drop(STREAM, BATCH)
    writer = (rows.hint("rebalance", partition) if partition else rows).write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(folder(table, GATHERED, number))
    for r in old:
        remove(spark, folder(table, r[STREAM], r[BATCH]))


# events


def _stage(batch: DataFrame, event_type: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    return telemetry_stage(batch, event_type, fields).withColumn(EVENT_DAY, F.to_date("event_timestamp"))


def _write_days(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", EVENT_DAY).write.mode("overwrite").partitionBy(EVENT_DAY).parquet(path)


def append_new_events(
    raw: DataFrame,
    event_type: str,
    fields: Mapping[str, tuple[str, str]],
    table: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Incremental staging of one event type (T1): an event that arrives again in a later batch,
    recognised by device and time, changes nothing. Nothing is rewritten, and of the events stored
    before only the keys of the days that a batch falls on are read."""

    def write(batch: DataFrame, stream: str, number: int) -> None:
        spark = batch.sparkSession
        typed = _stage(batch, event_type, fields).persist()
        try:
            stored = _rows(spark, table)
            fresh = typed
            if stored is not None:
                days = [r[0] for r in typed.select(EVENT_DAY).distinct().collect()]  # at most the calendar's
                on_day = F.col(EVENT_DAY).isin([d for d in days if d is not None])
                if None in days:
                    on_day = on_day | F.col(EVENT_DAY).isNull()
                own = (F.col(STREAM) == stream) & (F.col(BATCH) == number)
                keys = [EVENT_DAY, *EVENT]
                known = stored.filter(on_day & ~own).select(*[F.col(k).alias(f"_{k}") for k in keys])
                same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
                fresh = typed.join(known, same, "left_anti")
            _write_days(fresh, folder(table, stream, number))
        finally:
            typed.unpersist()

    return _each_batch(raw, checkpoint, every, write)


def _one_delivery(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return latest_per_key(rows, EVENT, newest_first(*order))


def new_events(spark: SparkSession, table: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame | None:
    """Reading side of `append_new_events`. Writers that ran at the same time, or a `gather` that died,
    may have left an event twice; the oldest delivery counts."""
    order = [F.col("_loaded_at"), *newest_first(*fields)]
    return _folded(spark, table, lambda rows: latest_per_key(rows, EVENT, order))


def keep_latest_events(
    raw: DataFrame,
    event_type: str,
    fields: Mapping[str, tuple[str, str]],
    table: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """As `append_new_events`, but a later delivery of an event replaces the earlier one."""

    def write(batch: DataFrame, stream: str, number: int) -> None:
        _write_days(_stage(batch, event_type, fields), folder(table, stream, number))

    return _each_batch(raw, checkpoint, every, write)


def latest_deliveries(fields: Mapping[str, tuple[str, str]]) -> Fold:
    """The fold of `keep_latest_events`, for `gather` and readers."""
    return lambda rows: _one_delivery(rows, ["_loaded_at", *fields])


def latest_events(spark: SparkSession, table: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame | None:
    return _folded(spark, table, latest_deliveries(fields))


LATENESS = "1 hour"


def first_of_late_events(
    raw: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    lateness: str = LATENESS,
    slack: str = LATENESS,
) -> tuple[StreamingQuery, StreamingQuery]:
    """One row per device, event time and type: the first to arrive.

    Events loaded within ``lateness`` of their time go through a watermark, whose state forgets them
    after that and ``slack``; later ones are split off before it, to plain files by day. ``slack`` is by
    how much rows may arrive out of the order of their load; what passes even that is counted as
    dropped in the stream's progress. Returns the queries for rows in time and late ones.
    """
    delay = F.expr(f"INTERVAL {lateness}")
    in_time = F.coalesce(F.col("_loaded_at") - F.col("event_timestamp") <= delay, F.lit(False))
    rows = raw.withColumn("event_data", F.col("event_data").cast("string"))
    # Spark's watermarks take instants; sessions run in UTC
    timed = rows.filter(in_time).withColumn("_at", F.col("event_timestamp").cast("timestamp"))
    wait = " ".join([lateness, slack])
    first = timed.withWatermark("_at", wait).dropDuplicatesWithinWatermark([*ANY_EVENT, "_at"]).drop("_at")

    def start(part: DataFrame, name: str) -> StreamingQuery:
        dated = part.withColumn(EVENT_DAY, F.to_date("event_timestamp"))
        writer = dated.writeStream.partitionBy(EVENT_DAY).option("checkpointLocation", f"{checkpoint}/{name}")
        return writer.trigger(**_trigger(every)).start(f"{table}/{name}", format="parquet")

    return start(first, "in_time"), start(rows.filter(~in_time), "late")


def first_events(spark: SparkSession, table: str) -> DataFrame | None:
    """Rows kept in time, and of the late ones those without such a row, the earliest load of each."""
    in_time, late = _rows(spark, f"{table}/in_time"), _rows(spark, f"{table}/late")
    if late is None:
        return in_time
    late = latest_per_key(late, ANY_EVENT, [F.col("_loaded_at").asc_nulls_last(), F.col("event_data")])
    if in_time is None:
        return late
    known = in_time.select(*[F.col(k).alias(f"_{k}") for k in (EVENT_DAY, *ANY_EVENT)])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (EVENT_DAY, *ANY_EVENT)]
    return in_time.unionByName(late.join(known, same, "left_anti"))


# One row per key, in Spark's state


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of every key as an aggregate; nulls count as oldest. Combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(row).select(*keys, "_row.*")


def _keep_newest(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], table: str, checkpoint: str, every: str | None
) -> StreamingQuery:
    """Each batch writes the rows of the keys it changed, as they are after it."""

    def write(batch: DataFrame, stream: str, number: int) -> None:
        batch.write.mode("overwrite").parquet(folder(table, stream, number))

    conf = rows.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)  # a query takes it over when it starts
    try:
        return _each_batch(newest(rows, keys, order), checkpoint, every, write, "update")
    finally:
        conf.set(PROVIDER, before)


STATUS_ORDER = ("event_timestamp", "_loaded_at", "event_type", "event_data")
STATUS_REFRESH = "5 minutes"  # fixed value: target lag of the serving table


def maintain_latest_status(
    raw: DataFrame, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Latest event per device, kept up to date (T3). Run it ``every`` `STATUS_REFRESH`. State holds one
    row per device."""
    columns = ["device_id", "event_type", "event_timestamp", F.col("event_data").cast("string"), "_loaded_at"]
    return _keep_newest(raw.select(*columns), ["device_id"], STATUS_ORDER, table, checkpoint, every)


def latest_status(rows: DataFrame) -> DataFrame:
    """The fold of `maintain_latest_status`."""
    return latest_per_key(rows, ["device_id"], newest_first(*STATUS_ORDER))


def status_at(spark: SparkSession, table: str, as_of) -> DataFrame | None:
    """Reading side of `maintain_latest_status`, with the connection state at reading time."""
    latest = _folded(spark, table, latest_status)
    return latest and latest.select(
        "device_id",
        F.col("event_type").alias("latest_event_type"),
        F.col("event_timestamp").alias("latest_event_timestamp"),
        F.col("event_data").alias("latest_event_data"),
        F.col("_loaded_at").alias("latest_loaded_at"),
        connectivity(F.col("event_timestamp"), as_of).alias("device_connectivity_status"),
    )


def _change_order(rows: DataFrame, tie_break: Sequence[str]) -> list[str]:
    return ["_source_ts", *[c for c in tie_break if c in rows.columns]]


def maintain_current_state(
    log: DataFrame,
    key: str,
    table: str,
    checkpoint: str,
    every: str | None = None,
    tie_break: Sequence[str] = TIE_BREAK,
) -> StreamingQuery:
    """A change log folded into one current row per key (T4). Delete rows are skipped, as in the batch
    models. State holds one row per key."""
    live = log.filter(F.col("_op") != "DELETE")
    return _keep_newest(live, [key], _change_order(log, tie_break), table, checkpoint, every)


def current_rows(key: str, tie_break: Sequence[str] = TIE_BREAK) -> Fold:
    """The fold of `maintain_current_state`."""
    return lambda rows: latest_per_key(rows, [key], newest_first(*_change_order(rows, tie_break)))


def current_state(
    spark: SparkSession, table: str, key: str, tie_break: Sequence[str] = TIE_BREAK
) -> DataFrame | None:
    return _folded(spark, table, current_rows(key, tie_break))


# T5: versions in buckets


def with_bucket(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def maintain_versions(
    log: DataFrame,
    key: str,
    table: str,
    checkpoint: str,
    updated_at: str = "updated_at",
    every: str | None = None,
    tie_break: Sequence[str] = TIE_BREAK,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """The version set of a change log (T5), in hash buckets of the key.

    A batch reads and overwrites the buckets its keys fall into, no others. Several changes of a
    key in one batch are as many versions, and a late change takes its place among those stored
    before, so the outcome does not depend on how the log is cut into batches.
    """

    def write(batch: DataFrame, stream: str, number: int) -> None:
        spark = batch.sparkSession
        live = batch.filter((F.col("_op") != "DELETE") & F.col(updated_at).isNotNull())
        changes = with_bucket(live, key, buckets).persist()
        try:
            touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            stored, rows = read_if_exists(spark, table), changes
            if stored is not None:
                before = stored.filter(F.col(BUCKET).isin(touched)).select(changes.columns)
                rows = before.unionByName(changes)
            order = newest_first(*_change_order(rows, tie_break))
            rows = latest_per_key(rows, [key, updated_at], order)
            found = scd2_from_log(rows, key, updated_at, None, tie_break, "dbt_valid_from", "dbt_valid_to")
            found = found.withColumn("dbt_scd_id", surrogate_key(key, updated_at)).withColumn(
                "dbt_updated_at", F.col(updated_at)
            )
            replace_partitions(found, table, [BUCKET], f"{checkpoint}/work/{stream}-{number}")
        finally:
            changes.unpersist()

    return _each_batch(log, checkpoint, every, write)


def versions(spark: SparkSession, table: str) -> DataFrame | None:
    """Reading side of `maintain_versions`, with the columns of a snapshot table."""
    found = read_if_exists(spark, table)
    return found and found.drop(BUCKET)
