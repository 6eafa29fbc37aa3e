"""Lookups, bridges and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .current import latest_per_key


def one_per_key(dim: DataFrame, key: str, order_by: str) -> DataFrame:
    """Guard for a lookup: one row per natural key, lowest ``order_by`` first."""
    return latest_per_key(dim, [key], [F.col(order_by).asc_nulls_last()])


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Column | str,
    key: str,
    take: Mapping[str, str],
    small: bool = False,
) -> DataFrame:
    """LEFT JOIN that fetches columns of a dimension unique on ``key``.

    ``on`` is a column or expression over the facts; ``take`` maps dimension columns to
    output names, so one dimension can be looked up in several roles. ``small`` is for
    dimensions whose size is fixed by construction (the calendar, the minutes of a day)
    and broadcasts them; every other size is left to the statistics Spark has at run
    time, and a fact key that holds a large share of the rows to its skew split.
    """
    expression = F.col(on) if isinstance(on, str) else on
    keyed = dim.select(
        F.col(key).alias("_lookup_key"),
        *[F.col(c) if c == n else F.col(c).alias(n) for c, n in take.items()],
    )
    if small:
        keyed = F.broadcast(keyed)
    return facts.join(keyed, expression == F.col("_lookup_key"), "left").drop("_lookup_key")


def full_outer(
    left: DataFrame, right: DataFrame, on: Sequence[str], prefer: str = "left"
) -> DataFrame:
    """FULL JOIN on equal names with the key columns merged."""
    other = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & (left[c] == other[f"_r_{c}"])
    keys = [
        F.coalesce(*((left[c], other[f"_r_{c}"]) if prefer == "left" else (other[f"_r_{c}"], left[c]))).alias(c)
        for c in on
    ]
    rest = [left[c] for c in left.columns if c not in on]
    rest += [other[c] for c in right.columns if c not in on]
    return left.join(other, condition, "full").select(*keys, *rest)


def equal_weights(pairs: DataFrame, key: str, name: str = "allocation_pct") -> DataFrame:
    """1 / rows of the key on each of its rows.

    Counts with a pre-aggregated group-by and joins back, so no group has to fit a task.
    """
    sizes = pairs.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        pairs.join(sizes, F.col(key).eqNullSafe(F.col("_k")))
        .withColumn(name, F.lit(1.0) / F.col("_n"))
        .drop("_k", "_n")
    )


def not_in(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose non-NULL ``column`` is NOT IN the parent column.

    SQL's ``NOT IN`` is empty as soon as the parent column holds one NULL. Spark plans
    it as a broadcast of the whole parent; the anti join plus a one-row test for NULLs
    gives the same rows at any parent size.
    """
    keys = parent.select(F.col(field).alias("_parent_key"))
    orphans = child.filter(F.col(column).isNotNull()).join(
        keys.filter(F.col("_parent_key").isNotNull()),
        F.col(column) == F.col("_parent_key"),
        "left_anti",
    )
    has_null = keys.agg(
        F.coalesce(F.bool_or(F.col("_parent_key").isNull()), F.lit(False)).alias("n")
    )
    return orphans.filter(~has_null.scalar())
