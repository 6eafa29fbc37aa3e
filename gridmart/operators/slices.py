"""Ordered windows over groups of any size.

A window sends each group to one task. For groups that may hold a large share
of all rows, the functions here cut the group into slices along its order,
work inside each slice, and carry what earlier (or later) slices contribute
over a small summary of one row per group and slice. Results equal the plain
window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group with more rows than this is cut, at this many quantiles of its own order: a slice
# holds a thousandth of its group, and stays below HOT_ROWS for groups of up to 10^9 rows.
HOT_ROWS = 1_000_000
CUTS = 1_024

# `_slice` is NULL in ordinary groups. `_part` is the group with its slice, as one struct:
# unlike its members a struct is never NULL, so it serves windows and equi-joins alike and
# both find the rows where one shuffle on it has put them.
SLICE, PART = "_slice", "_part"


def with_slices(
    df: DataFrame, keys: Sequence[str], order: str, hot_rows: int = HOT_ROWS, cuts: int = CUTS
) -> DataFrame:
    """Add ``_slice``: NULL in ordinary groups, a number that grows with ``order`` in groups
    above ``hot_rows``. Equal values share a slice.

    Groups are counted on the key columns alone, combined before they are shuffled; quantiles
    are sketched for hot groups only, from their own rows, combined likewise. One plan for
    all sizes; how the list of hot groups meets the rows is left to its size at run time.
    """
    group, value = F.struct(*keys), F.col(order)
    hot = (
        df.groupBy(group.alias("_hot_group"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select("_hot_group")
    )
    steps = [i / cuts for i in range(1, cuts)]
    points = (
        df.select(group.alias("_hot_group"), value.alias("_value"))
        .join(hot, "_hot_group", "left_semi")
        .groupBy("_hot_group")
        .agg(F.percentile_approx("_value", steps, 10 * cuts).alias("_points"))
    )
    return (
        df.join(points, group == F.col("_hot_group"), "left")
        .withColumn(SLICE, F.when(F.col("_hot_group").isNotNull(), _points_at_or_below(value, cuts)))
        .withColumn(PART, F.struct(*keys, SLICE))
        .drop("_points", "_hot_group")
    )


def _points_at_or_below(value: Column, cuts: int) -> Column:
    """Binary search in the sorted array ``_points``; 0 where value or points are NULL."""
    steps = F.lit([1 << i for i in reversed(range(cuts.bit_length()))])

    def climb(found: Column, step: Column) -> Column:
        at = found + step
        fits = (at <= F.size("_points")) & (F.try_element_at("_points", at) <= value)
        return F.when(F.coalesce(fits, F.lit(False)), at).otherwise(found)

    return F.aggregate(steps, F.lit(0), climb)


def _per_part(df: DataFrame, aggregate: Column) -> DataFrame:
    """One row per slice of the hot groups; empty if there are none."""
    hot = df.filter(F.col(SLICE).isNotNull())
    return hot.groupBy(F.col(PART).alias("_p")).agg(aggregate.alias("_value"))


def _carry(df: DataFrame, carried: DataFrame) -> DataFrame:
    return df.join(carried, F.col(PART) == F.col("_p"), "left").drop("_p")


def _slices_of(keys: Sequence[str]):
    return Window.partitionBy(*[f"_p.{k}" for k in keys]).orderBy(f"_p.{SLICE}")


def _earlier_slices(keys: Sequence[str]):
    return _slices_of(keys).rowsBetween(Window.unboundedPreceding, -1)


def _carried(per_part: DataFrame, value: Column) -> DataFrame:
    return per_part.select("_p", value.alias("_carried")).filter(F.col("_carried").isNotNull())


def sliced_sum_before(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Sum of ``value`` over the rows of the group ordered before this one, 0 for the first."""
    sums = _per_part(df, F.sum(value))
    carried = _carried(sums, F.sum("_value").over(_earlier_slices(keys)))
    before = Window.partitionBy(PART).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(before), F.lit(0))
    return (
        _carry(df.withColumn(name, local), carried)
        .withColumn(name, F.col(name) + F.coalesce("_carried", F.lit(0)))
        .drop("_carried", SLICE, PART)
    )


def sliced_lead(
    df: DataFrame, keys: Sequence[str], order: str, name: str, source: DataFrame | None = None
) -> DataFrame:
    """The next value of ``order`` in the group; ``order`` is unique per group and not NULL.

    ``source`` may hold the same values of ``order``, repeated or not, at a lower price
    than ``df``; the summary of slices is then made from it.
    """
    firsts = _per_part(df if source is None else source, F.min(order))
    following = _carried(firsts, F.lead("_value").over(_slices_of(keys)))
    local = F.lead(order).over(Window.partitionBy(PART).orderBy(order))
    return (
        _carry(df.withColumn(name, local), following)
        .withColumn(name, F.coalesce(name, "_carried"))
        .drop("_carried", SLICE, PART)
    )


def sliced_max_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    name: str,
    source: DataFrame | None = None,
) -> DataFrame:
    """Largest ``value`` among the rows of the group ordered before this one.

    Keeps the slices, so that `sliced_lead` can follow on the same cut.
    """
    highest = _per_part(df if source is None else source, F.max(value))
    carried = _carried(highest, F.max("_value").over(_earlier_slices(keys)))
    earlier_rows = (
        Window.partitionBy(PART).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        _carry(df.withColumn(name, F.max(value).over(earlier_rows)), carried)
        .withColumn(name, F.greatest(name, "_carried"))
        .drop("_carried")
    )


def occurrence_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "occurrence",
    hot_rows: int = HOT_ROWS,
    cuts: int = CUTS,
) -> DataFrame:
    """Number the rows of each group by the columns ``order``, NULL first.

    Rows that agree in keys and order are counted first, which shrinks every group to its
    distinct places; a place's first number is a running sum over them, sliced where a group
    is hot. Rows of one place may be numbered in any order: they are dealt to shares of at
    most about ``hot_rows`` by a hash of the whole row, numbered in each, and shares follow
    one another. Rows equal in *every* column stay in one share; remove such copies first,
    as staging does.
    """
    place = [*keys, *order]
    counted = df.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"))
    cut = with_slices(counted, keys, order[0], hot_rows, cuts)
    by_order = [F.col(c).asc_nulls_first() for c in order]
    first = sliced_sum_before(cut, keys, by_order, "_rows", "_before")
    shares = F.ceil(F.col("_rows") / hot_rows) if hot_rows else F.col("_rows")
    where = first.select(F.struct(*place).alias("_place"), "_before", shares.cast("long").alias("_shares"))
    row_hash = F.xxhash64(*df.columns)
    rows = df.join(where, F.struct(*place) == F.col("_place")).withColumn(
        "_share", F.pmod(row_hash, "_shares")
    )
    sizes = (
        rows.filter("_shares > 1")
        .groupBy(F.struct("_place", "_share").alias("_s"))
        .agg(F.count(F.lit(1)).alias("_size"))
    )
    earlier = Window.partitionBy("_s._place").orderBy("_s._share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_s", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_place", "_share").orderBy(row_hash))
    numbered = rows.withColumn("_inside", inside).join(
        offsets, F.struct("_place", "_share") == F.col("_s"), "left"
    )
    number = F.col("_before") + F.coalesce("_offset", F.lit(0)) + F.col("_inside")
    return numbered.select(*df.columns, number.cast("int").alias(name))
