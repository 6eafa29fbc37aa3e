"""Running sums in a total order, for groups of any size.

Rows are dealt into ranges of (group, order, position in the input), so that neither a hot group nor a
hot value ends in one task. A window adds up inside each range; what earlier ranges of the group hold
is carried by one row per group and range.

Defined results: nulls come first and are a group and a value like any other; rows that agree in group
and order are numbered in any order among themselves, so give an order that is total but for
interchangeable rows; an empty table gives an empty table; other columns are kept. Names that begin
with ``_run_`` are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def same(left: DataFrame, right: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Join on columns of which null equals null; ``on`` names the right side's for the left's, which
    must differ. The right side's are dropped."""
    condition = None
    for a, b in on.items():
        one = F.col(a).eqNullSafe(F.col(b))
        condition = one if condition is None else condition & one
    return left.join(right, condition, how).drop(*on.values())


def running(
    df: DataFrame, groups: list[str], order: list[str], value: str | None, before: str, total: str
) -> DataFrame:
    """Adds ``before``, the sum of ``value`` (None: the number) over the rows of the group that come
    earlier, and ``total``, that of the whole group. Both are long. ``groups`` may be empty."""
    ascending = [F.col(c).asc_nulls_first() for c in [*groups, *order]]
    amount = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    ranged = (
        df.withColumn("_run_at", F.monotonically_increasing_id())
        .repartitionByRange(*ascending, "_run_at")
        .withColumn("_run_part", F.spark_partition_id())
        .withColumn("_run_amount", amount)
    )
    ranged = stored(ranged, "ranges")
    sums = ranged.groupBy(*groups, "_run_part").agg(F.sum("_run_amount").alias("_run_sum"))
    by_group = Window.partitionBy(*groups)  # a row per range
    earlier = by_group.orderBy("_run_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(g).alias(f"_run_group_{i}") for i, g in enumerate(groups)],
        F.col("_run_part").alias("_run_range"),
        F.coalesce(F.sum("_run_sum").over(earlier), F.lit(0)).alias("_run_offset"),
        F.sum("_run_sum").over(by_group).alias(total),
    )
    inside = (
        Window.partitionBy("_run_part", *groups)
        .orderBy(*ascending[len(groups) :], "_run_at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = F.coalesce(F.sum("_run_amount").over(inside), F.lit(0))
    on = {"_run_part": "_run_range"} | {g: f"_run_group_{i}" for i, g in enumerate(groups)}
    found = same(ranged.withColumn("_run_local", local), offsets, on, "inner")
    return found.withColumn(before, F.col("_run_local") + F.col("_run_offset")).select(
        *df.columns, before, total
    )
