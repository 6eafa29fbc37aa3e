"""Named queries: a Spark function and, where SQL can say it, the DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle import query as oracle_query

Query = Callable[[SparkSession, str], DataFrame]

SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines report numbers of one kind."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def add(name: str, spark_query: Query, sql: str | None = None, doubles: str = "") -> None:
    """``doubles`` lists the decimal columns of the result, which both sides cast."""
    if name in SPARK:
        raise ValueError(f"query {name} is registered twice")
    SPARK[name] = lambda spark, sf_dir: plain(spark_query(spark, sf_dir))
    if sql:
        SQL[name] = oracle_query(sql.strip(), doubles)
