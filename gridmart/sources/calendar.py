"""Generated dimensions: days and minutes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key

# Fixed public holidays as (month, day), bands and hours.
FIXED_HOLIDAYS = ((1, 1), (6, 5), (12, 24), (12, 25), (12, 26))
BANDS = ((6, "night"), (12, "morning"), (18, "afternoon"))
LAST_BAND = "evening"
BUSINESS_HOURS = (8, 16)


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day of a given range; days outside it get no key (see `dates_over`)."""
    return _days(spark.range(1).select(F.lit(first).cast("date"), F.lit(last).cast("date")))


def dates_over(dated: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row per day of the whole years that the dates in (table, column) lie in.

    Every table is reduced to its first and last day before anything meets.
    """
    spans = None
    for table, column in dated:
        day = F.to_date(column)
        span = table.agg(F.min(day).alias("first"), F.max(day).alias("last"))
        spans = span if spans is None else spans.unionByName(span)
    ends = spans.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return _days(
        ends.filter("first IS NOT NULL").select(
            F.trunc("first", "year"), F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
        )
    )


def _days(ends: DataFrame) -> DataFrame:
    """The calendar between the two dates of a one-row frame."""
    days = ends.toDF("first", "last").select(F.explode(F.sequence("first", "last")).alias("d"))
    d = F.col("d")
    iso_day = F.weekday(d) + 1
    holiday = F.concat_ws("-", F.month(d), F.day(d)).isin(
        [f"{month}-{day}" for month, day in FIXED_HOLIDAYS]
    )
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        iso_day.alias("day_of_week_num"),
        F.weekofyear(d).alias("week_number_iso"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (iso_day >= 6).alias("is_weekend"),
        holiday.alias("is_danish_public_holiday"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
    )


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row per minute of a day."""
    minutes = spark.range(24 * 60).select(
        F.floor(F.col("id") / 60).cast("int").alias("hour"), (F.col("id") % 60).cast("int").alias("minute")
    )
    band = F.when(F.col("hour") < BANDS[0][0], BANDS[0][1])
    for before, name in BANDS[1:]:
        band = band.when(F.col("hour") < before, name)
    return minutes.select(
        (F.col("hour") * 100 + F.col("minute")).alias("time_key"),
        "hour",
        "minute",
        band.otherwise(LAST_BAND).alias("time_of_day_band"),
        F.col("hour").between(*BUSINESS_HOURS).alias("is_business_hour"),
    )
