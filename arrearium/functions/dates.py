"""Months, whole days and calendars."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def as_date(v: date | datetime | str) -> Column:
    return F.lit(v).cast("date")


def as_timestamp(v: date | datetime | str) -> Column:
    return F.lit(v).cast("timestamp")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def whole_days_since(moment: Column, as_of: Column) -> Column:
    """Full 24-hour days between two timestamps, never below zero."""
    micros = F.unix_micros(as_of) - F.unix_micros(moment)
    return F.greatest(F.lit(0), F.floor(micros / F.lit(DAY_MICROS)).cast("int"))


def months_between(first: Column, last: Column) -> Column:
    """Array of first-of-month dates; empty when ``last`` is before ``first``."""
    step = F.expr("INTERVAL 1 MONTH")
    lo, hi = month_start(first), month_start(last)
    return F.when(hi >= lo, F.sequence(lo, hi, step)).otherwise(
        F.array().cast("array<date>")
    )


def month_end_list(first: date | str, last: date | str) -> list[date]:
    """The month ends from the month of ``first`` to the month of ``last``."""
    lo, hi = (date.fromisoformat(str(d)[:10]) for d in (first, last))
    out = []
    year, month = lo.year, lo.month
    while (year, month) <= (hi.year, hi.month):
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
        out.append(date(year, month, 1) - timedelta(days=1))
    return out


def calendar(spark: SparkSession, first: date | str, last: date | str) -> DataFrame:
    """One row per month: month_start, month_end.  Its size is set by the two dates."""
    months = months_between(as_date(first), as_date(last))
    one = spark.range(1, numPartitions=1)
    return one.select(F.explode(months).alias("month_start")).withColumn(
        "month_end", month_end(F.col("month_start"))
    )
