"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import fiscal_month, fiscal_year


def calendar_between(bounds: DataFrame, start: str = "start", as_of: str = "as_of") -> DataFrame:
    """One row per day from ``start`` up to, but without, a year after the month end of ``as_of``.

    ``bounds`` is a one-row table; nothing is collected.
    """
    stop = F.date_sub(F.add_months(F.last_day(as_of), 12), 1)
    first = F.col(start).cast("date")
    days = bounds.select(F.explode(F.sequence(first, F.greatest(first, stop))).alias("Date")).where(
        F.col("Date").isNotNull()
    )
    day = F.col("Date")
    short = F.date_format(day, "MMM")
    return days.select(
        day,
        F.dayofmonth(day).alias("DayNumber"),
        F.dayofmonth(day).alias("Day"),
        F.date_format(day, "MMMM").alias("Month"),
        short.alias("ShortMonth"),
        F.month(day).alias("CalendarMonthNumber"),
        F.concat(F.lit("CY"), F.year(day), F.lit("-"), short).alias("CalendarMonthLabel"),
        F.year(day).alias("CalendarYear"),
        F.concat(F.lit("CY"), F.year(day)).alias("CalendarYearLabel"),
        fiscal_month(day).alias("FiscalMonthNumber"),
        F.concat(F.lit("FY"), fiscal_year(day), F.lit("-"), short).alias("FiscalMonthLabel"),
        fiscal_year(day).alias("FiscalYear"),
        F.concat(F.lit("FY"), fiscal_year(day)).alias("FiscalYearLabel"),
        F.weekofyear(day).alias("ISOWeekNumber"),
    )


def calendar(spark: SparkSession, start, as_of) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(as_of).cast("date").alias("as_of")
    )
    return calendar_between(bounds)
