"""Running totals and first-of-group marks that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearium.functions.dates import month_start


def monthly_running_total(facts: DataFrame, key: str, on: str, amount: str, total: str) -> DataFrame:
    """Cumulative sum per key at each month that has facts; facts without a date count in none.

    Facts collapse to one row per (key, month) first; the window then sees at most one
    row per month and key.
    """
    months = facts.where(F.col(on).isNotNull()).groupBy(key, month_start(F.col(on)).alias("month_start")).agg(
        F.sum(amount).alias("month_amount")
    )
    upto = Window.partitionBy(key).orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    return months.withColumn(total, F.sum("month_amount").over(upto))


def mark_first(df: DataFrame, key: str, row_id: str, order: Sequence[str], name: str) -> DataFrame:
    """Add a boolean column: is this the first row of its key in ``order``?  Nulls come last.

    ``row_id`` is unique.  A ranking window would send a hot key's rows to one task;
    here the first id per key is an aggregate, and the rows are matched on their own
    unique id, which spreads evenly.
    """
    places = [part for c in order for part in (F.col(c).isNull(), F.col(c))]
    firsts = (
        df.groupBy(key)
        .agg(F.min_by(F.col(row_id), F.struct(*places, row_id)).alias("_first_id"))
        .select("_first_id")
    )
    return (
        df.join(firsts, F.col(row_id) == F.col("_first_id"), "left")
        .withColumn(name, F.col("_first_id").isNotNull())
        .drop("_first_id")
    )
