"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a NULL part, so that keys are never NULL themselves.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column | str) -> Column:
    """32 hex digits over the text of ``parts``; a NULL part hashes as a token.

    Decimals hash at their own scale, so cast to a fixed scale before.
    """
    texts = []
    for part in parts:
        column = F.col(part) if isinstance(part, str) else part
        texts.append(F.coalesce(column.cast("string"), F.lit(NULL_KEY_TOKEN)))
    return F.md5(F.concat_ws("-", *texts))
