"""Tables laid out for how they are read: joins without an exchange, lookups and filters that skip files.

All are plain Parquet written by Spark; a layout changes what a query reads or shuffles, never its rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import CODEC, released

BUCKETS = 256
HOT_SHARE = 8  # a bucket of so many times the mean is left to run-time splitting, if it is large
HOT_ROWS = 5_000_000
DISTINCT = 100_000  # values of a looked-up column that a row group's Bloom filter is made for
GROUP_BYTES = 16 << 20  # of a row group in files made for point lookups
ZORDER_BITS = 8
SAMPLE = 200_000  # rows from which the cut points of a Z-order are taken


# --- buckets: joins on the key without an exchange


def _table_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` in hash buckets of ``key``, sorted by it. Tables with the same number of buckets join on
    their keys where they lie (J1, J2).

    Spark cannot split a bucket at run time. So a table of which one bucket is far larger than the
    others (a key, or null, with a large share of the rows) is returned as ordinary files.
    """
    spark, name = df.sparkSession, _table_name(path)
    writer = df.repartition(buckets, key).write.mode("overwrite").options(path=path, **CODEC)
    with released(spark):
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    table = spark.table(name)
    per_file = table.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    most, rows = per_file.agg(F.max("n"), F.sum("n")).first()
    if most and most > HOT_ROWS and most > HOT_SHARE * rows / buckets:
        return spark.read.schema(df.schema).parquet(path)
    return table


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """A table of `write_bucketed` in another session, which does not know its buckets yet."""
    name, schema = _table_name(path), spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{os.fspath(path)}'"
    )
    return spark.table(name)


# --- point lookups


def _bloom(columns: Sequence[str], distinct: int) -> dict[str, str]:
    options = {}
    for c in columns:
        options[f"parquet.bloom.filter.enabled#{c}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct)
    return options


def write_lookup(
    df: DataFrame,
    path: str,
    key: str,
    others: Sequence[str] = (),
    group_bytes: int = GROUP_BYTES,
    distinct: int = DISTINCT,
) -> DataFrame:
    """``df`` for lookups of single values (P13, V2, V3): in ranges of ``key``, sorted by it, in small row
    groups with Bloom filters for it and for ``others``, by which rows are not sorted.

    A lookup by ``key`` reads the pages that hold it, one by another column the row groups that may.
    A value with many rows spans files, as rows are spread by a hash as well.
    """
    spread = F.xxhash64(*[c for c, t in df.dtypes if "variant" not in t])
    writer = df.repartitionByRange(F.col(key), spread).sortWithinPartitions(key).write.mode("overwrite")
    options = _bloom([key, *others], distinct) | {"parquet.block.size": str(group_bytes)}
    with released(df.sparkSession):
        writer.options(**options, **CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- folders by month


def month_of(date_key: str) -> str:
    """The partition column of a table in folders by the month of ``date_key``."""
    return f"{date_key}_month"


def write_by_month(
    df: DataFrame, path: str, date_key: str, sort: str | None = None, made: Mapping[str, Column] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` in a folder per month of ``date_key`` (yyyymmdd), which stays as a column. Joined with a
    filtered calendar on day and month, only the months that are left are read (M1, J13).

    Within a month rows are sorted by ``sort``, for which row groups have Bloom filters. Columns in
    ``made`` are expressions over the others; they are not sent to their month but made there. ``columns``
    are the table's, if ``df`` lacks some that are made or has others that they are made of.
    """
    month = month_of(date_key)
    rows = df.withColumn(month, F.floor(F.col(date_key) / 100).cast("int"))
    made = dict(made or {})
    spread = rows.drop(*made).hint("rebalance", month).withColumns(made).select(*(columns or df.columns), month)
    writer = spread.sortWithinPartitions(month, *([sort] if sort else [])).write.mode("overwrite").partitionBy(month)
    with released(df.sparkSession):
        writer.options(**_bloom([sort] if sort else [], DISTINCT), **CODEC).parquet(path)
    return df.sparkSession.read.schema(spread.schema).parquet(path)


# --- Z-order: filters on any of several columns


def _cut_points(sample: DataFrame, column: str, parts: int) -> list:
    """At most ``parts`` values that cut the column's values into ranges of about equal size."""
    ranges = sample.select(column).filter(F.col(column).isNotNull()).repartitionByRange(parts, column)
    lows = ranges.groupBy(F.spark_partition_id().alias("_part")).agg(F.min(column).alias("_low"))
    return sorted(r[0] for r in lows.select("_low").collect())


def _rank(value: Column, points: list, data_type) -> Column:
    """How many of ``points`` are at or below ``value``, by binary search; 0 for null."""
    if not points:
        return F.lit(0)
    array = F.array(*[F.lit(p).cast(data_type) for p in points])
    steps = F.lit([1 << i for i in reversed(range(len(points).bit_length()))])

    def climb(found: Column, step: Column) -> Column:
        at = found + step
        fits = (at <= len(points)) & (F.try_element_at(array, at) <= value)
        return F.when(F.coalesce(fits, F.lit(False)), at).otherwise(found)

    return F.aggregate(steps, F.lit(0), climb)


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """The interleaved bits of the columns' ranks. Ranks come from cut points of a bounded sample, so
    columns may be of any type that has an order, and skewed."""
    rows = df.select(*columns)
    rows = rows.sample(min(1.0, SAMPLE / max(1, rows.count())), seed=0)
    key = F.lit(0).cast("long")
    for j, column in enumerate(columns):
        points = _cut_points(rows, column, (1 << bits) - 1)
        rank = _rank(F.col(column), points, df.schema[column].dataType).cast("long")
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("long"))
            key = key + F.shiftleft(bit, i * len(columns) + j)
    return key


def write_zordered(
    df: DataFrame, path: str, columns: Sequence[str], bits: int = ZORDER_BITS, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``df`` along a Z-order of ``columns`` (S17): a filter on any of them skips most row groups."""
    spread = F.xxhash64(*[c for c, t in df.dtypes if "variant" not in t])
    keyed = df.withColumn("_z", zorder_key(df, columns, bits))
    ranged = keyed.repartitionByRange(F.col("_z"), spread).sortWithinPartitions("_z").drop("_z")
    ranged.write.mode("overwrite").option("parquet.block.size", str(group_bytes)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
