"""Stream-kept tables: late and repeated events, repeated batches, restarts."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridmart.streaming import progress, sources, upserts
from workload import domain, stream_queries

RAW = "event_data string, device_id string, event_type string, event_timestamp timestamp_ntz, _loaded_at timestamp_ntz, _ingestion_date date"
FIELDS = {"kwh": ("kwh", "double")}
START = datetime(2025, 1, 1)


def event(device, minute, load, kwh):
    at = START + timedelta(minutes=minute)
    loaded = START + timedelta(minutes=load)
    return (json.dumps({"payload": {"kwh": kwh}}), device, "energy_reading", at, loaded, loaded.date())


BATCHES = [
    [event("a", 1, 2, 1.0), event("a", 1, 3, 1.5), event("b", 1, 3, 2.0)],
    [event("a", 1, 5, 9.0), event("b", 2, 5, 3.0)],
    [event("c", 1, 7, 4.0), event("b", 2, 7, 3.5), event("a", 1441, 1442, 5.0)],
]


def run(spark, folder, start):
    """Feed the batches one by one, each in a run of its own, as after a restart."""
    for data in BATCHES:
        spark.createDataFrame(data, RAW).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        start(sources.table_stream(spark, f"{folder}/in", RAW)).awaitTermination()


def test_append_never_repeats_an_event(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    run(spark, tmp_path, lambda s: upserts.append_new_events(s, "energy_reading", FIELDS, table, check))
    found = upserts.new_events(spark, table, FIELDS)
    assert rows(found, "device_id", "kwh") == [("a", 1.5), ("a", 5.0), ("b", 2.0), ("b", 3.0), ("c", 4.0)]


def test_latest_delivery_wins(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    run(spark, tmp_path, lambda s: upserts.keep_latest_events(s, "energy_reading", FIELDS, table, check))
    found = upserts.latest_events(spark, table, FIELDS)
    assert rows(found, "device_id", "kwh") == [("a", 5.0), ("a", 9.0), ("b", 2.0), ("b", 3.5), ("c", 4.0)]


def fed(spark, tmp_path, data, start):
    spark.createDataFrame(data, RAW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for query in start(sources.table_stream(spark, f"{tmp_path}/in", RAW)):
        query.awaitTermination()


LATE = [[event("a", 720, 721, 1.0)], [event("a", 1200, 1201, 2.0), event("a", 1200, 1202, 7.0)],
        [event("a", 540, 1202, 3.0), event("a", 540, 1203, 8.0), event("a", 720, 1202, 9.0)]]


@pytest.mark.parametrize("one_by_one", [True, False])
def test_first_delivery_wins_however_late(spark, tmp_path, rows, one_by_one):
    """An event of 09:00 that arrives after one of 20:00 is kept, its repeat is not."""
    out, check = str(tmp_path / "t"), str(tmp_path / "c")
    for data in LATE if one_by_one else [sum(LATE, [])]:
        fed(spark, tmp_path, data, lambda s: upserts.first_of_late_events(s, out, check))
    found = upserts.first_events(spark, out).select("event_timestamp", F.get_json_object("event_data", "$.payload.kwh"))
    minutes = [((at - START).total_seconds() / 60, kwh) for at, kwh in rows(found)]
    # in one batch nothing says which of two deliveries of 20:00 came first
    assert [m for m in minutes if m[0] != 1200] == [(540, "3.0"), (720, "1.0")]
    assert [m[0] for m in minutes].count(1200) == 1


def test_no_row_is_lost_between_state_and_late_files(spark, tmp_path):
    """Distinct events in, in time or late: as many come out, and none is dropped by the watermark."""
    out, check = str(tmp_path / "t"), str(tmp_path / "c")
    data = [[event("a", 100 * b + m, 100 * b + m + lag, 1.0) for m, lag in ((0, 1), (30, 59), (31, 61), (50, 500))] for b in range(4)]
    dropped = 0
    for part in data:
        spark.createDataFrame(part, RAW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        queries = upserts.first_of_late_events(sources.table_stream(spark, f"{tmp_path}/in", RAW), out, check)
        for query in queries:
            query.awaitTermination()
            dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    late = spark.read.parquet(f"{out}/late").count()
    kept = spark.read.parquet(f"{out}/in_time").count()
    assert (kept, late, dropped) == (8, 8, 0) and upserts.first_events(spark, out).count() == 16


def test_days_a_batch_does_not_touch_are_not_read(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    run(spark, tmp_path, lambda s: upserts.append_new_events(s, "energy_reading", FIELDS, table, check))
    leaves = {p.parent.relative_to(table).as_posix().split("/", 1)[1] for p in (tmp_path / "t").rglob("*.parquet")}
    assert leaves == {"batch=0/event_date=2025-01-01", "batch=1/event_date=2025-01-01",
                      "batch=2/event_date=2025-01-01", "batch=2/event_date=2025-01-02"}
    # a batch that is done again replaces its own files
    before = rows(upserts.new_events(spark, table, FIELDS))
    stream = json.loads((tmp_path / "c" / "metadata").read_text())["id"]
    assert spark.read.parquet(upserts.folder(table, stream, 2)).count() == 2
    (tmp_path / "c" / "commits" / "2").unlink()
    (tmp_path / "c" / "commits" / ".2.crc").unlink()
    raw = sources.table_stream(spark, f"{tmp_path}/in", RAW)
    upserts.append_new_events(raw, "energy_reading", FIELDS, table, check).awaitTermination()
    assert rows(upserts.new_events(spark, table, FIELDS)) == before
    assert spark.read.parquet(upserts.folder(table, stream, 2)).count() == 2


def test_gathering_changes_nothing(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    start = lambda s: upserts.keep_latest_events(s, "energy_reading", FIELDS, table, check)
    fold = upserts.latest_deliveries(FIELDS)
    upserts.gather(spark, table, fold)
    run(spark, tmp_path, start)
    before = rows(upserts.latest_events(spark, table, FIELDS))
    for turn in range(2):
        upserts.gather(spark, table, fold, upserts.EVENT_DAY)
        assert rows(upserts.latest_events(spark, table, FIELDS)) == before
        assert [p.name for p in (tmp_path / "t" / "stream=gathered").iterdir()] == [f"batch={turn}"]
    spark.createDataFrame([event("z", 5, 6, 1.0)], RAW).write.mode("append").parquet(f"{tmp_path}/in")
    start(sources.table_stream(spark, f"{tmp_path}/in", RAW)).awaitTermination()
    assert upserts.latest_events(spark, table, FIELDS).count() == len(before) + 1


def test_latest_status(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    run(spark, tmp_path, lambda s: upserts.maintain_latest_status(s, table, check))
    as_of = F.lit(START + timedelta(minutes=50)).cast("timestamp_ntz")
    found = upserts.status_at(spark, table, as_of).select("device_id", "latest_event_timestamp", "device_connectivity_status")
    assert rows(found) == [
        ("a", START + timedelta(minutes=1441), "online"), ("b", START + timedelta(minutes=2), "stale"), ("c", START + timedelta(minutes=1), "stale"),
    ]


LOG = "_op string, _source_ts timestamp_ntz, _loaded_at timestamp_ntz, _connector_batch_id string, k bigint, status string, updated_at timestamp_ntz"


def change(op, key, hour, status):
    at = START + timedelta(hours=hour)
    return (op, at, at, "b", key, status, at)


CHANGES = [
    [change("INSERT", 1, 1, "new"), change("INSERT", 2, 1, "new"), change("UPDATE", 1, 2, "on")],
    [change("UPDATE", 1, 5, "off"), change("DELETE", 2, 5, "gone"), change("INSERT", 3, 4, "new")],
    [change("UPDATE", 1, 3, "late")],
]


def replay(spark, folder, start):
    for data in CHANGES:
        spark.createDataFrame(data, LOG).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        start(sources.table_stream(spark, f"{folder}/log", LOG)).awaitTermination()


def test_current_state(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    start = lambda s: upserts.maintain_current_state(s, "k", table, check)
    replay(spark, tmp_path, start)
    expected = [(1, "off"), (2, "new"), (3, "new")]
    assert rows(upserts.current_state(spark, table, "k"), "k", "status") == expected
    # an older change does not come out of the state again: the key's row is written as it stands
    last = sorted((tmp_path / "t").glob("*/batch=*"))[-1]
    assert rows(spark.read.parquet(str(last)), "k", "status") == [(1, "off")]
    assert list((tmp_path / "c" / "state").rglob("*.zip")), "state is in RocksDB"
    # the last batch again, as after a failure
    (tmp_path / "c" / "commits" / "2").unlink()
    (tmp_path / "c" / "commits" / ".2.crc").unlink()
    start(sources.table_stream(spark, f"{tmp_path}/log", LOG)).awaitTermination()
    assert rows(upserts.current_state(spark, table, "k"), "k", "status") == expected
    upserts.gather(spark, table, upserts.current_rows("k"))
    assert rows(upserts.current_state(spark, table, "k"), "k", "status") == expected


def hour(n):
    return START + timedelta(hours=n)


ALL_VERSIONS = [
    (1, "late", hour(3), hour(5)), (1, "new", hour(1), hour(2)), (1, "off", hour(5), None), (1, "on", hour(2), hour(3)),
    (2, "new", hour(1), None), (3, "new", hour(4), None),
]


@pytest.mark.parametrize("one_by_one", [True, False])
def test_versions_do_not_depend_on_batches(spark, tmp_path, rows, one_by_one):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    start = lambda s: upserts.maintain_versions(s, "k", table, check, buckets=2)
    if one_by_one:
        replay(spark, tmp_path, start)
    else:
        every = [c for data in CHANGES for c in data]
        spark.createDataFrame(every, LOG).coalesce(1).write.parquet(f"{tmp_path}/log")
        start(sources.table_stream(spark, f"{tmp_path}/log", LOG)).awaitTermination()
    found = rows(upserts.versions(spark, table), "k", "status", "dbt_valid_from", "dbt_valid_to")
    assert found == ALL_VERSIONS


def test_a_fresh_checkpoint_loses_no_row(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    for turn, data in enumerate(CHANGES):
        spark.createDataFrame(data, LOG).coalesce(1).write.parquet(f"{tmp_path}/log{turn}")
        source = sources.table_stream(spark, f"{tmp_path}/log{turn}", LOG)
        upserts.maintain_versions(source, "k", table, f"{tmp_path}/c{turn}", buckets=2).awaitTermination()
    found = rows(upserts.versions(spark, table), "k", "status", "dbt_valid_from", "dbt_valid_to")
    assert found == ALL_VERSIONS


def files_of(folder):
    return {p.relative_to(folder).as_posix(): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_buckets_a_batch_does_not_touch_stay_as_they_are(spark, tmp_path, rows):
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    many = [change("INSERT", k, 1, "new") for k in range(200)]

    def feed(data):
        spark.createDataFrame(data, LOG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        source = sources.table_stream(spark, f"{tmp_path}/log", LOG)
        upserts.maintain_versions(source, "k", table, check, buckets=16).awaitTermination()

    feed(many)
    before = files_of(tmp_path / "t")
    feed([change("UPDATE", 7, 2, "on"), change("UPDATE", 7, 2, "on")])
    after = files_of(tmp_path / "t")
    changed = {name.split("/")[0] for name, _ in set(before.items()) ^ set(after.items())}
    assert len({n.split("/")[0] for n in before}) == 16 and len(changed) == 1
    found = upserts.versions(spark, table)
    assert found.count() == 201 and rows(found.filter("k = 7"), "status", "dbt_valid_to") == [("new", hour(2)), ("on", None)]
    assert not list((tmp_path / "c" / "work").iterdir())


def test_a_run_that_died_while_replacing_is_finished(spark, tmp_path, rows):
    from gridmart.sources import sinks

    table, work = str(tmp_path / "t"), str(tmp_path / "w")
    frame = lambda data: spark.createDataFrame(data, "b int, v int")
    sinks.replace_partitions(frame([(0, 1), (1, 1), (2, 1)]), table, ["b"], str(tmp_path / "w0"))
    frame([(0, 2), (1, 2)]).write.parquet(work)  # what the dead run had written down
    sinks.remove(spark, f"{table}/b=0")
    sinks.replace_partitions(frame([(1, 99)]), table, ["b"], work)
    assert rows(spark.read.parquet(table), "b", "v") == [(0, 2), (1, 2), (2, 1)]


def test_streams_report_their_freshness(spark, tmp_path, rows):
    path = str(tmp_path / "progress")
    as_of = F.lit(START + timedelta(minutes=25)).cast("timestamp_ntz")
    assert rows(progress.stream_freshness(progress.read_progress(spark, path), "iot", as_of), "state") == [("error",)]
    log = progress.ProgressLog(spark, path)
    spark.streams.addListener(log)
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    ended = []

    def start(source):
        seen = progress.observed(source)
        ended.append(upserts.append_new_events(seen, "energy_reading", FIELDS, table, check))
        return ended[-1]

    try:
        run(spark, tmp_path, start)
        assert all(log.wait_for(query) for query in ended)
    finally:
        spark.streams.removeListener(log)
    found = progress.read_progress(spark, path)
    at = [START + timedelta(minutes=m) for m in (3, 5, 1442)]
    assert rows(found.filter("rows > 0"), "batch", "rows", "max_loaded_at") == [(0, 3, at[0]), (1, 2, at[1]), (2, 3, at[2])]
    only = found.filter("batch < 2")
    assert rows(progress.stream_freshness(only, "iot", as_of)) == [("iot", at[1], 20, "warn")]


def test_event_lines(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"device_id": "d", "event_type": "x", "event_timestamp": "2025-01-01T00:00:00Z"}\n{broken\n')
    out = str(tmp_path / "out")
    stream = sources.event_lines(spark, str(tmp_path / "in"))
    assert stream.isStreaming
    stream.select("device_id", "event_timestamp", F.col("_loaded_at").isNotNull().alias("stamped")).writeStream.option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    assert rows(spark.read.parquet(out)) == [(None, None, True), ("d", START, True)]


def test_a_stream_of_many_files_has_no_more_batches_than_writes(spark, sf_dir, tmp_path, monkeypatch):
    class ManyFiles(domain.RawFeeds):
        def __missing__(self, name):
            return super().__missing__(name).repartition(12)

    monkeypatch.setattr(domain, "RawFeeds", ManyFiles)
    seen = []
    rows = stream_queries.stream(spark, sf_dir, "customers", "_source_ts", 2)
    writer = rows.writeStream.foreachBatch(lambda batch, number: seen.append(batch.count()))
    writer.option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) <= 2 and sum(seen) == ManyFiles(spark, sf_dir)["customers"].count()
