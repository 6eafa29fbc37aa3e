"""Checks: failing rows are found, sound rows pass."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridmart.operators import quality as Q


def test_column_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z")], "k bigint, v string")
    assert Q.not_null(df, "k").count() == 1
    assert rows(Q.unique(df, "k")) == [(1, 2)]
    assert rows(Q.accepted_values(df, "v", ["a", "b"])) == [("z", 1)]
    parent = spark.createDataFrame([(1,), (None,)], "p bigint")
    assert rows(Q.relationships(df, "k", parent, "p")) == [(2,)]
    assert rows(Q.referential_integrity(df, "k", parent, "p")) == []
    assert rows(Q.referential_integrity(df, "k", parent.dropna(), "p")) == [(2,)]


def test_collisions_ignore_natural_keys_with_nulls(spark, rows):
    df = spark.createDataFrame([("s", 1, "a"), ("s", 1, None), ("t", 1, "a"), ("t", 2, "a")], "sk string, x bigint, y string")
    assert rows(Q.surrogate_key_collision(df, "sk", ["x", "y"])) == [("t", 2)]


def test_contract_rules(spark, rows):
    t = datetime(2025, 1, 2)
    df = spark.createDataFrame([
        (1, "active", date(2025, 1, 1), None, t, t),
        (2, "open", None, None, t, t),
        (3, "expired", None, None, t, t - timedelta(days=1)),
        (4, "active", None, None, t, t),
        (5, None, None, None, None, t),
    ], "contract_id bigint, status string, start_date date, end_date date, created_at timestamp_ntz, updated_at timestamp_ntz")
    assert rows(Q.contract_status_rules(df)) == [
        ("active_missing_start_date", 4), ("invalid_status", 2), ("terminal_missing_end_date", 3), ("updated_before_created", 3),
    ]


def test_daily_rules(spark, rows):
    d = date(2025, 1, 1)
    df = spark.createDataFrame([
        ("a", d, 5.0, 4.0, 20.0, 1), ("b", d, 3.0, 4.0, None, 1), ("c", d, None, 4.0, 81.0, 0), ("e", d, 1.0, 1.0, 0.0, 1), ("e", d, 1.0, 1.0, 0.0, 1),
    ], "device_id string, reading_date date, total_kwh double, peak_kwh double, avg_temperature double, total_reading_count bigint")
    assert [(r[0], r[1]) for r in rows(Q.daily_rollup_rules(df))] == [
        ("duplicate_grain", "e"), ("implausible_temperature", "c"), ("total_kwh_less_than_peak", "b"), ("zero_reading_count", "c"),
    ]


def test_volume_needs_three_days_and_thirty_percent(spark, rows):
    today = date(2025, 1, 20)
    days = [today - timedelta(days=n) for n in range(0, 9)]
    data = [("steady", 100, d) for d in days] + [("jump", 200 if d == today else 100, d) for d in days]
    data += [("young", 900 if d == today else 1, d) for d in days[:3]]
    data += [("zero", 5 if d == today else 0, d) for d in days]
    history = spark.createDataFrame(data, "model_name string, row_count bigint, measured_at date")
    found = rows(Q.volume_anomaly(history, F.lit(today)), "model_name", "deviation_pct")
    assert found == [("jump", 1.0)]


@pytest.mark.parametrize("age, state", [(30, "pass"), (31, "warn"), (60, "warn"), (61, "error")])
def test_freshness(spark, age, state):
    now = datetime(2025, 1, 1, 12)
    df = spark.createDataFrame([(now - timedelta(minutes=age),), (now - timedelta(days=9),)], "_loaded_at timestamp_ntz")
    assert Q.freshness(df, "oltp", F.lit(now).cast("timestamp_ntz")).first()["state"] == state


def test_no_rows_are_not_fresh(spark):
    empty = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert Q.freshness(empty, "iot", F.localtimestamp()).first()["state"] == "error"


def test_contract_names_every_difference(spark):
    df = spark.createDataFrame([(1, "a", True)], "k bigint, v string, extra boolean")
    assert Q.enforce_contract(df.drop("extra"), "v string, k bigint").columns == ["v", "k"]
    with pytest.raises(ValueError, match="k: declared int, found bigint; gone: declared date, found None; extra"):
        Q.enforce_contract(df, "k int, v string, gone date")


def test_pii_tags_survive_parquet(spark, tmp_path):
    df = Q.tag_pii(spark.createDataFrame([("e", 1)], "email string, k bigint"), ["email"])
    df.write.parquet(str(tmp_path / "t"))
    assert Q.pii_columns(spark.read.parquet(str(tmp_path / "t"))) == ["email"]
