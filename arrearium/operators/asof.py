"""As-of lookups against month ends without a range join.

For each key and calendar month the operator returns the newest row dated no later
than the month end (plus ``grace_days``) and, optionally, no earlier than the month
start minus ``lookback_days``.

Time is cut into cells in which every later date beats every earlier one for all
months: with grace g the cell of date d is the month of ``d - g``.  So

1. per key and cell only the newest row can ever win: aggregate (combines on the map
   side, so a hot key shrinks before the shuffle),
2. a cell's row serves the months from its own cell up to the month before the key's
   next cell, or until the look-back runs out,
3. exploding that interval gives exactly the result rows: no candidate pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearium.functions.dates import as_date, month_end, month_start


def asof_month_ends(
    df: DataFrame,
    key: str,
    on: str,
    first_month: date | str,
    last_month: date | str,
    lookback_days: int | None = None,
    grace_days: int = 0,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``df`` valid at each month end, with month_start and month_end added.

    Apply row filters before the call: they decide which rows can be the newest.
    ``tie`` orders rows of one key that share a date.
    """
    first, last = month_start(as_date(first_month)), month_start(as_date(last_month))
    payload = [c for c in df.columns if c != key]
    day = F.col(on).cast("date")

    # Plain comparisons with constants, so they reach the scan and prune date folders.
    usable = F.col(on) < F.date_add(F.last_day(last), grace_days + 1)
    if lookback_days is not None:
        usable = usable & (F.col(on) >= F.date_sub(first, lookback_days))

    newest = (
        df.filter(usable)
        .groupBy(key, month_start(F.date_sub(day, grace_days)).alias("_cell"))
        .agg(F.max_by(F.struct(*payload), F.struct(F.col(on), *tie)).alias("_row"))
    )
    by_key = Window.partitionBy(key).orderBy("_cell")
    until: Column = F.least(F.add_months(F.lead("_cell").over(by_key), -1), last)
    intervals = newest.withColumn("_until", until)
    if lookback_days is not None:
        reach = month_start(F.date_add(F.col(f"_row.{on}").cast("date"), lookback_days))
        intervals = intervals.withColumn("_until", F.least("_until", reach))

    start = F.greatest(F.col("_cell"), first)
    months = F.sequence(start, F.col("_until"), F.expr("INTERVAL 1 MONTH"))
    return (
        intervals.filter(F.col("_until") >= start)
        .select(F.explode(months).alias("month_start"), key, "_row")
        .select("month_start", month_end(F.col("month_start")).alias("month_end"), key, "_row.*")
        .select("month_start", "month_end", *df.columns)
    )


def latest_until(df: DataFrame, key: str, on: str, until: date | str, tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per key dated no later than ``until``."""
    payload = [c for c in df.columns if c != key]
    return (
        df.filter(F.col(on) <= as_date(until))
        .groupBy(key)
        .agg(F.max_by(F.struct(*payload), F.struct(F.col(on), *tie)).alias("_row"))
        .select(key, "_row.*")
        .select(*df.columns)
    )
