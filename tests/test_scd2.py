"""Snapshot merges and version lookups."""

from datetime import datetime

import pytest

from gridmart.operators.scd2 import as_of_version, scd2_merge

SCHEMA = "k bigint, status string, updated_at timestamp_ntz"
VERSION = ("k", "status", "dbt_valid_from", "dbt_valid_to")


def day(n):
    return datetime(2025, 1, n)


def source(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_two_runs(spark, rows):
    first = scd2_merge(None, source(spark, (1, "new", day(1)), (2, "new", day(1)), (3, "new", day(1))), "k")
    second = scd2_merge(
        first,
        source(spark, (1, "changed", day(5)), (2, "same time, ignored", day(1)), (4, "late", day(6))),
        "k",
    )
    assert rows(second, *VERSION) == [
        (1, "changed", day(5), None),
        (1, "new", day(1), day(5)),
        (2, "new", day(1), None),
        (3, "new", day(1), None),  # gone from the source, stays open
        (4, "late", day(6), None),
    ]
    assert second.select("dbt_scd_id").distinct().count() == 5


def test_merge_can_be_repeated(spark, rows):
    run = source(spark, (1, "a", day(2)), (2, "b", day(3)))
    once = scd2_merge(scd2_merge(None, source(spark, (1, "x", day(1))), "k"), run, "k")
    assert rows(scd2_merge(once, run, "k"), *VERSION) == rows(once, *VERSION)


def test_older_rows_do_not_reopen(spark, rows):
    versions = scd2_merge(None, source(spark, (1, "now", day(9))), "k")
    assert rows(scd2_merge(versions, source(spark, (1, "past", day(2))), "k"), *VERSION) == [(1, "now", day(9), None)]


@pytest.mark.parametrize("hot_rows", [1000, 0])
def test_version_valid_at_the_time_of_a_fact(spark, rows, hot_rows):
    versions = spark.createDataFrame(
        [(1, "old", day(1), day(5)), (1, "new", day(5), None)],
        "k bigint, label string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    facts = spark.createDataFrame(
        [(1, day(4)), (1, day(5)), (1, datetime(2024, 1, 1)), (2, day(4)), (None, day(4)), (1, None)], "k bigint, happened timestamp_ntz"
    )
    found = rows(as_of_version(facts, versions, "k", "happened", ["label"], hot_rows=hot_rows), "k", "happened", "label")
    assert found == [
        (1, datetime(2024, 1, 1), None), (1, day(4), "old"), (1, day(5), "new"),
        (1, None, None), (2, day(4), None), (None, day(4), None),
    ]
