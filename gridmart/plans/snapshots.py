"""Stored snapshots whose cost of writing follows the change.

A snapshot table has two sections of plain Parquet. ``closed`` is only appended to: a folder per run
with the versions that ended in it. ``open`` holds the open version of each key, in buckets of the
key; a run overwrites the buckets in which something changed and leaves the others alone.

A run first writes down what it changes. If it dies later, the next run carries that out before its own
work; every step writes to a place fixed by the run, so doing one twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd2 import scd2_changes
from ..sources.sinks import exists, finished, read_if_exists, remove, replace_partitions, write_once

BUCKETS = 256
BUCKET, RUN = "_bucket", "_run"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def run_snapshot(source: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Bring the snapshot at ``path`` up to date with ``source``; returns all versions."""
    spark = source.sparkSession
    run = _next_run(spark, path)
    if run and finished(spark, _changes(path, run - 1)) and not finished(spark, _done(path, run - 1)):
        _carry_out(spark, key, path, run - 1, buckets)
    write_once(scd2_changes(read_open(spark, path), source, key), _changes(path, run))
    _carry_out(spark, key, path, run, buckets)
    return read_versions(spark, path)


def _changes(path: str, run: int) -> str:
    return f"{path}/changes/run={run}"


def _done(path: str, run: int) -> str:
    return f"{path}/closed/{RUN}={run}"


def _next_run(spark: SparkSession, path: str) -> int:
    """Runs are counted by their folder of changes; that of the last one stays."""
    if not exists(spark, f"{path}/changes"):
        return 0
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/changes")
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    runs = [int(f.getPath().getName().split("=")[1]) for f in listed if "run=" in f.getPath().getName()]
    whole = [r for r in runs if finished(spark, _changes(path, r))]
    return max(whole) + 1 if whole else 0


def _carry_out(spark: SparkSession, key: str, path: str, run: int, buckets: int) -> None:
    """Replace the buckets that the changes fall into, then store the versions that ended. The second
    write's end is the run's."""
    changes = spark.read.parquet(_changes(path, run))
    bucket = bucket_of(F.col(f"new.{key}"), buckets)
    touched = [r[0] for r in changes.select(bucket).distinct().collect()]  # at most ``buckets``
    if touched:
        rows = changes.select("new.*", bucket.alias(BUCKET))
        opened = read_open(spark, path, touched)
        if opened is not None:
            gone = changes.select(F.col(f"new.{key}").alias("_changed"))
            kept = opened.join(gone, F.col(key) == F.col("_changed"), "left_anti")
            rows = kept.withColumn(BUCKET, bucket_of(F.col(key), buckets)).select(rows.columns).unionByName(rows)
        replace_partitions(rows, f"{path}/open", [BUCKET], f"{path}/work/run={run}")
    ended = F.col("old").withField("dbt_valid_to", F.col("new.dbt_updated_at"))
    closed = changes.filter("old IS NOT NULL").select(ended.alias("old")).select("old.*")
    closed.write.mode("overwrite").parquet(_done(path, run))
    if run:
        remove(spark, _changes(path, run - 1))


def read_open(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame | None:
    """The open versions, of some buckets or all."""
    found = read_if_exists(spark, f"{path}/open")
    if found is None:
        return None
    return (found if buckets is None else found.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)


def read_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions, open and closed."""
    closed = spark.read.parquet(f"{path}/closed").drop(RUN)
    opened = read_open(spark, path)
    return closed if opened is None else opened.select(closed.columns).unionByName(closed)
