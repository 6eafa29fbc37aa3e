"""Mergeable partials of metrics that do not add up: distinct counts, quantiles, top lists.

A day's facts shrink to one row of sketches. Rows are appended as days come, several for a day if its
facts came in several loads, and any span of days is answered from them: a year is 365 rows. Next to
the exact metrics, which stay as they are; errors are bounded by the sizes below.

Defined results: null values are in no sketch; a day without facts has no row; sketches of no values
answer 0 distinct, null quantiles and no top values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 14  # log2 of a distinct count's registers: standard error 0.8 %
KLL_K = 400  # of a quantile's sketch: rank error under 1 % with 99 % confidence
TRACKED = 10_000  # values that a top list follows: exact for up to 7,500 distinct ones


@dataclass(frozen=True)
class Distinct:
    name: str
    column: str


@dataclass(frozen=True)
class Quantiles:
    """Of a column that casts to double."""

    name: str
    column: str


@dataclass(frozen=True)
class Top:
    name: str
    column: str


Sketch = Distinct | Quantiles | Top


def _made(s: Sketch) -> Column:
    value = F.col(s.column)
    if isinstance(s, Distinct):
        return F.hll_sketch_agg(value, HLL_BITS)
    if isinstance(s, Quantiles):
        return F.kll_sketch_agg_double(value.cast("double"), KLL_K)
    return F.call_function("approx_top_k_accumulate", value, F.lit(TRACKED))


def _merged(s: Sketch) -> Column:
    if isinstance(s, Distinct):
        return F.hll_union_agg(s.name)
    if isinstance(s, Quantiles):
        return F.kll_merge_agg_double(s.name, KLL_K)
    return F.call_function("approx_top_k_combine", F.col(s.name), F.lit(TRACKED))


def daily(facts: DataFrame, by: Sequence[str], sketches: Sequence[Sketch]) -> DataFrame:
    """One row per value of ``by`` (a day, or a day and more), with its row count and sketches. Combined
    before the shuffle, so a day with any share of the facts costs a task no more than a sketch."""
    return facts.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[_made(s).alias(s.name) for s in sketches])


def append_daily(facts: DataFrame, path: str, by: Sequence[str], sketches: Sequence[Sketch]) -> DataFrame:
    """Add the sketches of newly loaded facts to the table at ``path``; earlier rows stay as they are."""
    daily(facts, by, sketches).coalesce(1).write.mode("append").parquet(path)
    return facts.sparkSession.read.parquet(path)


def merged(table: DataFrame, by: Sequence[str], sketches: Sequence[Sketch]) -> DataFrame:
    """Rows of `daily` brought together by other, coarser, columns."""
    return table.groupBy(*by).agg(F.sum("rows").alias("rows"), *[_merged(s).alias(s.name) for s in sketches])


def distinct_count(name: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(name), F.lit(0).cast("long"))


def quantile(name: str, q: float) -> Column:
    return F.when(F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, F.lit(q)))


def top(name: str, k: int) -> Column:
    """The ``k`` most frequent values as an array of (item, count), most frequent first."""
    return F.call_function("approx_top_k_estimate", F.col(name), F.lit(k))
