"""Typed access to semi-structured payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def payload_field(df: DataFrame, column: str, path: str, data_type: str) -> Column:
    """``$.a.b`` of a VARIANT or JSON-text column as ``data_type``; NULL if absent or malformed."""
    if isinstance(df.schema[column].dataType, T.VariantType):
        return F.try_variant_get(F.col(column), path, data_type)
    return F.get_json_object(F.col(column), path).try_cast(data_type)
