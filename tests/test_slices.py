"""Sliced windows equal plain ones, also where one group holds most rows or a key is NULL."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmart.operators.joins import equal_weights
from gridmart.operators.scd2 import scd2_from_log, scd2_overlapping_versions, scd2_overlaps
from gridmart.operators.slices import (
    PART,
    occurrence_ordinal,
    sliced_lead,
    sliced_max_before,
    with_slices,
)

START = datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def points(spark):
    """Key 0 holds half of the rows, the NULL key a fifth; times are unique per key."""
    rng = random.Random(7)
    data = []
    for key, n in ((0, 300), (None, 120), (1, 40), (2, 1), (3, 0)):
        for minute in rng.sample(range(5000), n):
            data.append((key, START + timedelta(minutes=minute), rng.choice([None, 1, 5, 5, 9, 20])))
    return spark.createDataFrame(data, "k bigint, ts timestamp_ntz, v bigint").repartition(5)


HOT = [10_000, 50, 0]  # no group is cut; large ones are; every group is


@pytest.mark.parametrize("hot_rows", HOT)
def test_lead(points, rows, hot_rows):
    cut = with_slices(points, ["k"], "ts", hot_rows, 16)
    plain = points.withColumn("n", F.lead("ts").over(Window.partitionBy("k").orderBy("ts")))
    assert rows(sliced_lead(cut, ["k"], "ts", "n"), "k", "ts", "n") == rows(plain, "k", "ts", "n")


@pytest.mark.parametrize("hot_rows", HOT)
def test_max_before(points, rows, hot_rows):
    cut = with_slices(points, ["k"], "ts", hot_rows, 16)
    before = Window.partitionBy("k").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    plain = points.withColumn("m", F.max("v").over(before))
    assert rows(sliced_max_before(cut, ["k"], "ts", "v", "m"), "k", "ts", "m") == rows(plain, "k", "ts", "m")


@pytest.mark.parametrize("slices", [4, 64])
@pytest.mark.parametrize("hot_rows", HOT)
def test_occurrence_ordinal(points, rows, hot_rows, slices):
    timed = points.withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    order = [F.col("v").asc_nulls_first(), F.col("t").asc_nulls_first()]
    plain = timed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    numbered = occurrence_ordinal(timed, ["k"], ["v", "t"], "n", hot_rows, slices)
    assert rows(numbered, "k", "ts", "v", "n") == rows(plain, "k", "ts", "v", "n")


@pytest.mark.parametrize("hot_rows", HOT)
def test_ordinals_of_equal_values_are_all_used(points, hot_rows):
    numbered = occurrence_ordinal(points, ["k"], ["v"], "n", hot_rows, 16)
    per_group = numbered.groupBy("k").agg(
        F.count("*").alias("c"), F.count_distinct("n").alias("d"), F.min("n").alias("a"), F.max("n").alias("b"))
    assert per_group.filter("c <> d OR a <> 1 OR b <> c").count() == 0
    # Larger values never come before smaller ones.
    spans = numbered.groupBy("k", "v").agg(F.min("n").alias("a"), F.max("n").alias("b"))
    after = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first())
    assert spans.withColumn("next", F.lead("a").over(after)).filter("next <= b").count() == 0


def test_slices_of_one_hot_hour_are_small(spark):
    """One key holds nearly all rows, all within one hour: no slice is left large."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 3600 + F.col("id") / 1e6)).alias("ts"))
    cut = with_slices(rows, ["k"], "ts", 1_000, 128)
    sizes = [r["count"] for r in cut.groupBy(PART).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 1_000
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_shares_of_a_hot_place_are_numbered_through(spark):
    """20,000 rows that agree in key and order: numbers are used once, in shares of a few hundred."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(5).alias("v"), "id")
    numbered = occurrence_ordinal(df, ["k"], ["v"], "n", 500, 8)
    found = numbered.agg(F.count_distinct("n").alias("d"), F.min("n").alias("a"), F.max("n").alias("b")).first()
    assert tuple(found) == (20_000, 1, 20_000)


@pytest.mark.parametrize("hot_rows", HOT)
def test_versions_from_log(spark, rows, hot_rows):
    rng = random.Random(3)
    data = [
        (rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), START + timedelta(minutes=rng.randrange(900)), f"b{i:04}", rng.choice([1, 1, 1, 2, 3]))
        for i in range(500)
    ]
    log = spark.createDataFrame(data, "_op string, _source_ts timestamp_ntz, _connector_batch_id string, k bigint")
    kept = {}
    for op, ts, batch, k in sorted(data, key=lambda r: r[2]):
        if op != "DELETE":
            kept[k, ts] = batch  # of changes at one instant the last batch wins
    expected = []
    for k in {k for k, _ in kept}:
        times = sorted(t for key, t in kept if key == k)
        expected += [(k, a, b, kept[k, a]) for a, b in zip(times, [*times[1:], None])]
    versions = scd2_from_log(log, "k", hot_rows=hot_rows)
    assert rows(versions, "k", "valid_from", "valid_to", "_connector_batch_id") == sorted(expected, key=lambda r: tuple(str(v) for v in r))


@pytest.mark.parametrize("hot_rows", HOT)
def test_overlaps_against_brute_force(spark, rows, hot_rows):
    rng = random.Random(11)
    data = []
    for _ in range(160):
        start = START + timedelta(minutes=rng.randrange(2000))
        end = None if rng.random() < 0.05 else start + timedelta(minutes=rng.randrange(-3, 90))
        data.append((rng.choice([1, 1, 1, 2, 3, None]), start, end))
    frame = spark.createDataFrame(data, "k bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
    pairs = [
        (a[0], a[1], a[2], b[1], b[2])
        for a in data for b in data
        if a[0] is not None and a[0] == b[0] and a[1] < b[1] and (a[2] is None or a[2] > b[1])
    ]
    found = rows(scd2_overlaps(frame, "k", hot_rows=hot_rows))
    assert found == sorted(pairs, key=lambda r: tuple(str(v) for v in r))
    starts = {(p[0], p[3]) for p in pairs}
    assert set(rows(scd2_overlapping_versions(frame, "k", hot_rows=hot_rows), "k", "valid_from")) == starts


def test_weights_count_null_keys_as_one_group(spark, rows):
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k bigint, v string")
    assert rows(equal_weights(pairs, "k"), "v", "allocation_pct") == [("a", 0.5), ("b", 0.5), ("c", 0.5), ("d", 0.5), ("e", 1.0)]
