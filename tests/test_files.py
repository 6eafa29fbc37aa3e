"""CSV, JSON and Parquet readers."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart.sources import files, schemas
from gridmart.sources.files import FileFormatError

DDL = "id bigint, day date, amount decimal(12,2), ok boolean, note string"


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_markers_quotes_and_blanks(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", 'id,day,amount,ok,note\n'
                 ' 1 ,2025-01-05, 1.50 ,true,"wifi, ""b/g/n"""\n2,NULL,null,\\N,\n3,,,false, x \n')
    assert rows(files.read_csv(spark, path, DDL)) == [
        (1, date(2025, 1, 5), Decimal("1.50"), True, 'wifi, "b/g/n"'), (2, None, None, None, None), (3, None, None, False, "x"),
    ]


@pytest.mark.parametrize("bad", ["2,2025-01-05,1", "2,2025-01-05,1,true,x,y", "two,,,,", "2,05.01.2025,,,", "2,,1e,,", "2,,,maybe,"])
def test_strict_load_fails_on_one_bad_row(spark, tmp_path, bad):
    path = write(tmp_path, "a.csv", f"id,day,amount,ok,note\n1,,,,\n{bad}\n")
    with pytest.raises(Exception, match="column|Malformed|MALFORMED|FAILED_READ"):
        files.read_csv(spark, path, DDL).collect()
    with pytest.raises(Exception):  # also when only one good column is asked for
        files.read_csv(spark, path, DDL).select("id", "day", "amount", "ok").collect()


def test_nested_types_are_refused(spark, tmp_path):
    with pytest.raises(FileFormatError):
        files.read_csv(spark, str(tmp_path), "a array<int>")


def test_tolerant_load(spark, tmp_path, rows):
    write(tmp_path, "a.csv", "id,day,amount,ok,note\n1,,,,a\n2,2025-01-05\nx,,,,b\n4,,,,c\n")
    write(tmp_path, "b.csv", "id,day,amount,ok,note\n5,,bad,no?,d\n6,,,,e,f,g\n7,,,,h\n")
    at = datetime(2025, 1, 1)
    load = files.load_csv_tolerant(spark, str(tmp_path), DDL, F.lit(at).cast("timestamp_ntz"))
    lineage = ("id", "_source_file_name", "_source_file_row_number", "_loaded_at")
    assert rows(load.good, *lineage) == [(1, "a.csv", 2, at), (4, "a.csv", 5, at), (7, "b.csv", 4, at)]
    assert rows(load.quarantined, "_source_file_name", "_source_file_row_number", "error_type", "record") == [
        ("a.csv", 3, "schema_mismatch", "2,2025-01-05"), ("a.csv", 4, "parse_error", "x,,,,b"),
        ("b.csv", 2, "parse_error", "5,,bad,no?,d"), ("b.csv", 3, "schema_mismatch", "6,,,,e,f,g"),
    ]
    assert rows(load.errors, "file_name", "error_type", "error_message", "record_count") == [
        ("a.csv", "parse_error", "not of its type: id", 1), ("a.csv", "schema_mismatch", "field count differs from the header", 1),
        ("b.csv", "parse_error", "not of its type: amount, ok", 1), ("b.csv", "schema_mismatch", "field count differs from the header", 1),
    ]
    declared = [f.split()[0] for f in schemas.FILE_ERRORS.split(", ")]
    assert load.errors.select(*declared).count() == 4


def test_row_numbers_of_files_read_in_blocks(spark, tmp_path, rows):
    for name, n in (("big.csv", 3000), ("small.csv", 10)):
        write(tmp_path, name, "id\n" + "".join(f"{i}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        load = files.load_csv_tolerant(spark, str(tmp_path), "id bigint")
        assert spark.read.option("header", True).csv(str(tmp_path)).rdd.getNumPartitions() > 5
        wrong = load.good.filter(F.col("_source_file_row_number") != F.col("id") + 2)
        assert load.good.count() == 3010 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


EVENT = {"device_id": "4008", "event_type": "alert_event", "event_timestamp": "2025-02-15T14:32:00Z",
         "payload": {"severity": "warning", "actual_value": -78, "battery": None}}


def test_json_arrays_and_lines(spark, tmp_path, rows):
    (tmp_path / "arrays").mkdir()
    (tmp_path / "lines").mkdir()
    other = EVENT | {"device_id": "x", "event_timestamp": "never"}
    write(tmp_path / "arrays", "a.json", json.dumps([EVENT, other], indent=2))
    write(tmp_path / "lines", "l.json", json.dumps(EVENT) + "\n" + json.dumps(other) + "\n")
    at = F.lit("2025-03-01 00:00:00").cast("timestamp_ntz")
    (tmp_path / "array_lines").mkdir()
    write(tmp_path / "array_lines", "a.json", json.dumps([EVENT, other]) + "\n[]\n{broken\n")
    for events in (
        files.read_json_array(spark, str(tmp_path / "arrays")),
        files.read_json_array_lines(spark, str(tmp_path / "array_lines")),
        files.read_json_lines(spark, str(tmp_path / "lines")),
    ):
        raw = files.telemetry_envelope(events, at)
        assert rows(raw.drop("event_data")) == [
            ("4008", "alert_event", datetime(2025, 2, 15, 14, 32), datetime(2025, 3, 1), date(2025, 3, 1)),
            ("x", "alert_event", None, datetime(2025, 3, 1), date(2025, 3, 1)),
        ]
        assert rows(raw.select(F.variant_get("event_data", "$.payload.actual_value", "int"))) == [(-78,), (-78,)]


def test_malformed_json_becomes_null(spark, rows):
    df = spark.createDataFrame([('{"a": 1}',), ("{oops",)], "t string")
    assert files.parse_events(df, "t").filter("event_data IS NULL").count() == 1


def test_parquet_filter_reaches_the_scan(spark, sf_dir):
    df = files.read_parquet(spark, f"{sf_dir}/lineitem.parquet").filter("l_quantity > 45").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_raw_schemas():
    tables = schemas.raw_tables()
    assert len(tables) == 23
    assert "_loaded_at" not in schemas.file_columns("customers") and "_sync_id" in schemas.file_columns("cases")
