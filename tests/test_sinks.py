"""Tables written in full, in increments, in clusters; the whole build."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridmart.operators.quality import pii_columns, schema_mismatches
from gridmart.operators.scd2 import scd2_merge
from gridmart.plans import checks, snapshots
from gridmart.plans.contracts import MART_SCHEMAS
from gridmart.plans.snapshots import run_snapshot
from gridmart.plans.warehouse import Warehouse
from gridmart.session import scratch_path
from gridmart.sources import sinks
from workload.domain import RawFeeds, warehouse


def feed(spark, *hours):
    return spark.createDataFrame([(h, datetime(2025, 1, 1, h)) for h in hours], "k bigint, _loaded_at timestamp_ntz")


def test_incremental_append(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert sinks.high_water_mark(spark, path) is None
    sinks.incremental_append(feed(spark, 1, 2), path, ["k"])
    table = sinks.incremental_append(feed(spark, 1, 2, 3), path, ["k"])
    assert rows(table, "k") == [(1,), (2,), (3,)]


def test_rows_loaded_at_the_mark_are_appended_once(spark, tmp_path, rows):
    path, at = str(tmp_path / "t"), datetime(2025, 1, 1, 1)
    for keys in ((1, 2), (1, 2, 3), (1, 2, 3)):
        df = spark.createDataFrame([(k, at) for k in keys], "k bigint, _loaded_at timestamp_ntz")
        table = sinks.incremental_append(df, path, ["k"])
    assert rows(table, "k") == [(1,), (2,), (3,)]


def test_high_water_mark(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.incremental_append(feed(spark, 1, 2, 3), path, ["k"])
    assert sinks.high_water_mark(spark, path) == datetime(2025, 1, 1, 3)


def test_layer_names(spark):
    assert sinks.layer_path("/root/", " marts ", "t") == "/root/marts/t"
    assert sinks.layer_path("/root", None, "t") == "/root/main/t"


def test_clustered_files_hold_disjoint_ranges(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") % 200).alias("date_key"), F.col("id"))
    table = sinks.write_clustered(df.repartition(8), str(tmp_path / "t"), "date_key")
    ranges = table.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("date_key").alias("a"), F.max("date_key").alias("b"))
    spans = sorted((r.a, r.b) for r in ranges.collect())
    assert table.count() == 4000 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_whole_build(spark, sf_dir, tmp_path):
    wh = warehouse(spark, sf_dir)
    written = wh.build(str(tmp_path))
    assert set(written) == set(MART_SCHEMAS)
    for name, table in written.items():
        assert schema_mismatches(table, MART_SCHEMAS[name]) == []
        assert table.count() > 0
    assert pii_columns(written["customer_360"]) == ["email", "first_name", "last_name", "phone", "address"]
    again = warehouse(spark, sf_dir)
    unchanged = again.snapshot("snp_customers", str(tmp_path))
    assert unchanged.filter("dbt_valid_to IS NOT NULL").count() == 0
    assert unchanged.count() == written["dim_customer"].count()
    counts = spark.read.parquet(str(tmp_path / "checks" / "row_counts"))
    assert {r.model_name: r.row_count for r in counts.collect()} == {n: t.count() for n, t in written.items()}
    failing = spark.read.parquet(str(tmp_path / "checks" / "failing_rows"))
    assert failing.columns == ["model", "check", "failing_row"] and failing.count() == 0


PEOPLE = "k bigint, status string, updated_at timestamp_ntz"


def people(spark, *changed):
    at = {k: datetime(2025, 1, 1) for k in range(500)} | {k: datetime(2025, 1, day) for k, day in changed}
    return spark.createDataFrame([(k, f"s{t.day}", t) for k, t in at.items()], PEOPLE)


def written(folder):
    return {p.relative_to(folder).as_posix(): (p.stat().st_mtime_ns, p.stat().st_size) for p in folder.rglob("*.parquet")}


def test_a_snapshot_writes_what_changed(spark, tmp_path, rows):
    path, columns = str(tmp_path / "s"), ["k", "status", "dbt_valid_from", "dbt_valid_to"]
    expected, runs = None, [people(spark), people(spark, (3, 2), (4, 2), (600, 2)), people(spark, (3, 3), (4, 2), (600, 2))]
    for source in runs:
        expected = scd2_merge(expected, source, "k")
        before = written(tmp_path / "s") if (tmp_path / "s").exists() else {}
        found = run_snapshot(source, "k", path, 64)
        assert rows(found, *columns) == rows(expected, *columns)
        new = {n: f for n, f in written(tmp_path / "s").items() if before.get(n) != f}
        open_buckets = {n for n in new if n.startswith("open/")}
        assert not before or len(open_buckets) <= 3
        assert not before or sum(size for _, size in new.values()) < sum(size for _, size in before.values()) / 4
    # nothing new: no bucket is touched
    before = written(tmp_path / "s")
    assert rows(run_snapshot(runs[-1], "k", path, 64), *columns) == rows(expected, *columns)
    assert {n: f for n, f in before.items() if n.startswith("open/")} == {
        n: f for n, f in written(tmp_path / "s").items() if n.startswith("open/")
    }


@pytest.mark.parametrize("died_after", ["changes", "open"])
def test_a_snapshot_run_that_died_is_carried_out_by_the_next(spark, tmp_path, rows, monkeypatch, died_after):
    path, columns = str(tmp_path / "s"), ["k", "status", "dbt_valid_from", "dbt_valid_to"]
    first, second, third = people(spark), people(spark, (3, 2)), people(spark, (3, 2), (5, 3))
    run_snapshot(first, "k", path, 8)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        def die(*args, **kwargs):
            if died_after == "open":
                sinks.replace_partitions(*args, **kwargs)
            raise RuntimeError("executor lost")
        patch.setattr(snapshots, "replace_partitions", die)
        run_snapshot(second, "k", path, 8)
    found = run_snapshot(third, "k", path, 8)
    expected = scd2_merge(scd2_merge(scd2_merge(None, first, "k"), second, "k"), third, "k")
    assert rows(found, *columns) == rows(expected, *columns)


def test_failing_rows_are_named(spark, rows):
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "customer_360_sk string, customer_id bigint")
    mine = tuple(c for c in checks.CHECKS if c.model == "customer_360")
    found = checks.failing_rows({"customer_360": dim}, mine)
    assert rows(found) == [
        ("customer_360", "not_null_customer_360_sk", '{"customer_id":3}'),
        ("customer_360", "unique_customer_360_sk", '{"customer_360_sk":"a","n_records":2}'),
    ]


RAW = "event_data string, device_id string, event_type string, event_timestamp timestamp_ntz, _loaded_at timestamp_ntz, _ingestion_date date"


def test_a_second_build_reads_only_what_came_since(spark, tmp_path, rows):
    def event(device, hour, kwh):
        at = datetime(2025, 1, 1, hour)
        return (f'{{"payload": {{"kwh_reading": {kwh}}}}}', device, "energy_reading", datetime(2025, 1, 1), at, at.date())

    def load(*events):
        raw = spark.createDataFrame(list(events), RAW)
        return Warehouse(spark, {"telemetry_events": raw}).load_telemetry(str(tmp_path))

    load(event("a", 1, 1), event("b", 2, 2))
    # a row below the mark is not read again, one at the mark and a newer delivery are
    staged = load(event("x", 1, 9), event("c", 2, 3), event("a", 3, 4))
    assert [(r[0], float(r[1])) for r in rows(staged, "device_id", "kwh_reading")] == [("a", 4.0), ("b", 2.0), ("c", 3.0)]


def scans_of_events(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and "event_id" in line for line in plan.splitlines())


def test_the_event_fact_reads_the_feed_once(spark, sf_dir):
    fact = warehouse(spark, sf_dir)["fct_device_telemetry"]
    feed_itself = scans_of_events(RawFeeds(spark, sf_dir)["telemetry_events"])
    lifecycle = scans_of_events(warehouse(spark, sf_dir)["int_device__lifecycle"])
    assert scans_of_events(fact) == feed_itself + lifecycle


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root) and first != second


def test_other_read_errors_are_not_taken_for_a_missing_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        sinks.read_if_exists(spark, str(tmp_path / "t")).count()


def test_checks_of_one_model_run_after_those_of_another(spark, tmp_path, rows, monkeypatch):
    """Their shuffle files do not lie beside one another; the table is that of all checks, however often it is written."""
    written = []
    monkeypatch.setattr(checks, "write_table", lambda df, path, mode: written.append(mode) or sinks.write_table(df, path, mode))
    models = {
        "customer_360": spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "customer_360_sk string, customer_id bigint"),
        "dim_time": spark.createDataFrame([(None,), (5,)], "time_key int"),
        "dim_product": spark.createDataFrame([("p", 1)], "product_sk string, product_id bigint"),
    }
    mine = tuple(c for c in checks.CHECKS if c.model in models)
    path = str(tmp_path / "failing_rows")
    want = rows(checks.failing_rows(models, mine), "model", "check", "failing_row")
    assert {m for m, *_ in want} == {"customer_360", "dim_time"}
    for _ in range(2):
        assert rows(checks.write_failing_rows(models, path, mine), "model", "check", "failing_row") == want
        assert rows(spark.read.parquet(path), "model", "check", "failing_row") == want
    assert written == 2 * ["overwrite", "append", "append"]
    few = tuple(c for c in mine if c.model == "dim_time")
    assert rows(checks.write_failing_rows(models, path, few)) == rows(spark.read.parquet(path), "model", "check", "failing_row")
