"""File readers (S1-S9): strict and tolerant CSV, JSON to VARIANT, Parquet, lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for NULL in a CSV field, after trimming.
NULL_MARKERS = ("", "NULL", "null", "\\N")

CORRUPT = "_corrupt_record"
FIRST_DATA_ROW = 2  # the header is row 1 of its file


class FileFormatError(ValueError):
    """A table DDL that a CSV file cannot carry."""


def _csv_schema(ddl: str) -> T.StructType:
    schema = T.StructType.fromDDL(ddl)
    nested = [f.name for f in schema if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    if nested:
        raise FileFormatError(f"nested columns in CSV: {nested}")
    return schema


def _scan(spark: SparkSession, path, schema: T.StructType, mode: str, multi_line: bool) -> DataFrame:
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    if mode == "PERMISSIVE":
        texts = texts.add(CORRUPT, T.StringType())
    return (
        spark.read.schema(texts)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("multiLine", multi_line)
        # Without this, a row with too many fields passes when columns are pruned.
        .option("columnPruning", False)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def _text(name: str) -> Column:
    trimmed = F.trim(F.col(name))
    return F.when(~trimmed.isin(*NULL_MARKERS), trimmed)


def read_csv(
    spark: SparkSession, path: str | list[str], ddl: str, multi_line: bool = False
) -> DataFrame:
    """Typed CSV scan that fails on the first bad row."""
    schema = _csv_schema(ddl)
    rows = _scan(spark, path, schema, "FAILFAST", multi_line)
    typed = []
    for field in schema:
        text, value = _text(field.name), _text(field.name).try_cast(field.dataType)
        if not isinstance(field.dataType, T.StringType):
            message = F.concat(
                F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "), text
            )
            value = F.when(text.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)
        typed.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*typed)


@dataclass(frozen=True)
class TolerantLoad:
    """Outcome of a load that skips bad rows: all three are lazy."""

    good: DataFrame
    quarantined: DataFrame
    errors: DataFrame


def file_rows(scan: DataFrame) -> DataFrame:
    """Add ``_source_file_name`` and ``_source_file_row_number`` to a text-file scan.

    Rows of one file block are read in order by one task, so a row's place in its block
    is its running id minus the block's lowest. Blocks are then lined up per file over a
    summary of one row per block; the rows themselves are neither sorted nor shuffled.
    """
    marked = scan.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_source_file_name": F.col("_metadata.file_name"),
            "_block": F.col("_metadata.file_block_start"),
            "_pos": F.monotonically_increasing_id(),
        }
    )
    earlier = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        marked.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b"))
        .agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    number = F.col("_pos") - F.col("_start") + F.col("_before") + FIRST_DATA_ROW
    return (
        marked.join(
            blocks, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")), "left"
        )
        .withColumn("_source_file_row_number", number)
        .drop("_file", "_block", "_pos", "_f", "_b", "_start", "_before")
    )


def load_csv_tolerant(
    spark: SparkSession,
    path: str | list[str],
    ddl: str,
    loaded_at: Column | None = None,
    multi_line: bool = False,
) -> TolerantLoad:
    """CSV load that keeps good rows and sets bad ones aside.

    A row is bad if its field count is off (``schema_mismatch``) or a field does not
    have its type (``parse_error``). Row numbers count bad rows too.
    """
    stamp = loaded_at if loaded_at is not None else F.localtimestamp()
    schema = _csv_schema(ddl)
    rows = file_rows(_scan(spark, path, schema, "PERMISSIVE", multi_line))

    typed, unparsed = [], []
    for field in schema:
        text = _text(field.name)
        value = text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            unparsed.append(F.when(text.isNotNull() & value.isNull(), F.lit(field.name)))
    bad_fields = F.array_compact(F.array(*unparsed)) if unparsed else F.array().cast("array<string>")
    lineage = ["_source_file_name", "_source_file_row_number"]
    checked = rows.select(
        "*",
        F.when(F.col(CORRUPT).isNotNull(), "schema_mismatch")
        .when(F.size(bad_fields) > 0, "parse_error")
        .alias("_error_type"),
        F.when(F.col(CORRUPT).isNotNull(), "field count differs from the header")
        .when(F.size(bad_fields) > 0, F.concat(F.lit("not of its type: "), F.array_join(bad_fields, ", ")))
        .alias("_error_message"),
    )
    good = checked.filter(F.col("_error_type").isNull()).select(
        *typed, stamp.cast("timestamp_ntz").alias("_loaded_at"), *lineage
    )
    raw = F.coalesce(
        F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f.name) for f in schema]))
    )
    quarantined = checked.filter(F.col("_error_type").isNotNull()).select(
        *lineage,
        F.col("_error_type").alias("error_type"),
        F.col("_error_message").alias("error_message"),
        raw.alias("record"),
    )
    errors = (
        quarantined.groupBy(
            F.col("_source_file_name").alias("file_name"), "error_type", "error_message"
        )
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("logged_at", stamp.cast("timestamp_ntz"))
    )
    return TolerantLoad(good, quarantined, errors)


def read_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One ``event_data`` VARIANT per element of the outer array of each file.

    A file holding one big array cannot be split; for volume, let there be an array or an
    event per line (`read_json_array_lines`, `read_json_lines`).
    """
    files = spark.read.option("multiLine", True).option("singleVariantColumn", "_v").json(path)
    return files.lateralJoin(
        spark.tvf.variant_explode(F.col("_v").outer())
    ).select(F.col("value").alias("event_data"))


def read_json_array_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same for files with an array per line, which split freely."""
    arrays = spark.read.text(path).select(F.try_parse_json("value").alias("_v"))
    return arrays.lateralJoin(
        spark.tvf.variant_explode(F.col("_v").outer())
    ).select(F.col("value").alias("event_data"))


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One ``event_data`` VARIANT per line; files split freely."""
    return spark.read.option("singleVariantColumn", "event_data").json(path)


def parse_events(df: DataFrame, column: str) -> DataFrame:
    """JSON text to ``event_data`` VARIANT (S7); malformed text becomes NULL."""
    return df.select(F.try_parse_json(column).alias("event_data"))


def telemetry_envelope(events: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """The raw telemetry table: payload plus extracted envelope and stamps."""
    def field(name: str, data_type: str) -> Column:
        return F.try_variant_get("event_data", f"$.{name}", data_type).alias(name)

    stamped = events.select(
        "event_data",
        field("device_id", "string"),
        field("event_type", "string"),
        field("event_timestamp", "timestamp_ntz"),
    )
    return with_load_stamps(stamped, loaded_at)


def with_load_stamps(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """``_loaded_at`` and ``_ingestion_date``, the partition column of raw events."""
    stamp = loaded_at if loaded_at is not None else F.localtimestamp()
    return df.withColumn("_loaded_at", stamp.cast("timestamp_ntz")).withColumn(
        "_ingestion_date", F.to_date("_loaded_at")
    )


def read_parquet(spark: SparkSession, path: str | list[str], ddl: str | None = None) -> DataFrame:
    """Parquet scan (S8); with a DDL, the columns are read under exactly that schema."""
    reader = spark.read
    if ddl:
        reader = reader.schema(ddl)
    return reader.parquet(*([path] if isinstance(path, str) else path))
