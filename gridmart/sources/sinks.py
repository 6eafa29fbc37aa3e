"""Sinks (S13-S15, S17, S18)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Surrogate keys are hex digits, which zstd halves and the default codec does not.
CODEC = {"compression": "zstd"}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """A write in here gives back its shuffle files when it ends. Otherwise they stay until the driver
    happens to collect garbage, and a build's disk holds those of all tables written so far."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def layer_path(root: str, layer: str | None, table: str, default_layer: str = "main") -> str:
    """Where a table lives: the layer name as given, or the default one."""
    name = layer.strip() if layer is not None else default_layer
    return f"{root.rstrip('/')}/{name}/{table}"


def create_view(df: DataFrame, name: str) -> None:
    """Lazy view."""
    df.createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Full rebuild (S14); returns the written table, so later steps start from files."""
    with released(df.sparkSession):
        df.write.mode(mode).options(**CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_clustered(df: DataFrame, path: str, by: str) -> DataFrame:
    """Full rebuild in ranges of ``by`` (S17): a filter on it skips most files.

    A value with a large share of the rows must not end in one file, so the ranges run
    over the column and a hash of the whole row.
    """
    spread = F.xxhash64(*[c for c, t in df.dtypes if "variant" not in t])
    ranged = df.repartitionByRange(F.col(by), spread).sortWithinPartitions(by)
    with released(df.sparkSession):
        ranged.write.mode("overwrite").options(**CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def high_water_mark(spark: SparkSession, path: str, column: str = "_loaded_at"):
    """Largest ``column`` of the table at ``path`` (A10), None without table or rows.

    Reads one column and brings one value to the driver.
    """
    table = read_if_exists(spark, path)
    return None if table is None else table.agg(F.max(column)).first()[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table, in whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def write_once(df: DataFrame, path: str) -> DataFrame:
    """``df`` at ``path``, unless an earlier try has already written it there in full."""
    spark = df.sparkSession
    if not finished(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace_partitions(
    rows: DataFrame, path: str, by: list[str], work: str, sort: list[str] | None = None
) -> None:
    """Overwrite the partitions of the table at ``path`` that ``rows`` holds; others stay as they are.

    ``rows`` may come from the table itself: they are first written to ``work``. A run that dies while
    partitions are replaced leaves ``work`` behind in full, and its repeat replaces them from there,
    so name ``work`` after what is repeated. A large partition becomes several files.
    """
    spark = rows.sparkSession
    ready = write_once(rows, work)
    spread = ready.hint("rebalance", *by)
    if sort:
        spread = spread.sortWithinPartitions(*by, *sort)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    remove(spark, work)


def incremental_append(
    df: DataFrame,
    path: str,
    keys: list[str],
    partition_by: list[str] | None = None,
    column: str = "_loaded_at",
) -> DataFrame:
    """Append the rows loaded since the newest the target has; the first run takes all.

    Rows loaded at the mark itself may be there already or not: those are told by ``keys``,
    among the stored rows of that instant only.
    """
    spark = df.sparkSession
    mark = high_water_mark(spark, path, column)
    fresh = df
    if mark is not None:
        at = F.lit(mark).cast(df.schema[column].dataType)
        stored = spark.read.parquet(path).filter(F.col(column) == at).select(*keys, column)
        fresh = df.filter(F.col(column) >= at).join(stored, [*keys, column], "left_anti")
        fresh = fresh.select(*df.columns)
    writer = fresh.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
