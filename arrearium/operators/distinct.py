"""Exact distinct counts that merge: bitmaps of numbered ids, kept for each slice.

A dictionary numbers the ids: within hash buckets, so no task numbers all, and new ids after the old ones of their
bucket, so numbers never change.  A slice stores bitmaps of its ids' numbers.  Distinct counts of any set of slices are
counted bits of OR-ed bitmaps; the rows behind them are not read again, and nothing is expanded per counted column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets of a dictionary; numbers of one bucket follow each other.
BUCKETS, ROOM = 256, 1 << 40


def number_ids(rows: DataFrame, id: str, known: DataFrame | None = None) -> DataFrame:
    """(id, number) of the distinct ids that ``known`` lacks; null has no number."""
    ids = rows.select(F.col(id).alias("id")).where("id IS NOT NULL").distinct()
    place = Window.partitionBy("bucket").orderBy("id")
    if known is not None:
        ids = ids.join(known.select("id"), "id", "left_anti")
    fresh = ids.select("id", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).alias("bucket"))
    numbered = fresh.withColumn("n", F.row_number().over(place).cast("long"))
    if known is not None:
        tops = known.groupBy(F.floor(F.col("number") / ROOM).alias("bucket")).agg((F.max(F.col("number") % ROOM) + 1).alias("top"))
        numbered = numbered.join(tops, "bucket", "left").withColumn("n", F.col("n") + F.coalesce("top", F.lit(0)))
    return numbered.select("id", (F.col("bucket") * ROOM + F.col("n") - 1).alias("number"))


def slice_bitmaps(rows: DataFrame, dictionary: DataFrame, id: str, by: Sequence[str]) -> DataFrame:
    """(by, part, bits): for each slice the bitmaps of its ids, a row for every 32,768 numbers that occur."""
    number = F.col("number")
    # Ids of a slice collapse before they meet the dictionary.
    own = rows.select(*by, F.col(id).alias("id")).where("id IS NOT NULL").distinct()
    return own.join(dictionary, "id").groupBy(*by, F.bitmap_bucket_number(number).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def merged_count(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per ``by`` columns (all slices without any) from the slices' bitmaps."""
    parts = bitmaps.groupBy(*by, "part").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return parts.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))
