"""Continuous versions of the batch loads.

Results of micro-batches are appended as ``batch=N`` folders and combined on read.
Writing a batch again replaces only its own folder, so a retried batch changes
nothing, and no stored data is rewritten while the stream runs.  ``compact`` folds the
folders into a new base when they grow many.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arrearium.operators.fold import flat_states, fold_states


def upsert_batch(
    path: str, keys: Sequence[str], sticky: Sequence[str], mutable: Sequence[str], order: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each micro-batch folded to one row per key."""

    def write(df: DataFrame, batch_id: int) -> None:
        at = F.struct(*order)
        rows = df.withColumn("_first_at", at).withColumn("_last_at", at)
        folded = flat_states(fold_states(rows, keys, sticky, mutable), keys, sticky, mutable)
        folded.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def upserted(
    spark: SparkSession, path: str, keys: Sequence[str], sticky: Sequence[str], mutable: Sequence[str]
) -> DataFrame:
    """Current state of an upserted table: all stored batches folded."""
    rows = spark.read.parquet(path)
    state = flat_states(fold_states(rows, keys, sticky, mutable), keys, sticky, mutable)
    return state.drop("_first_at", "_last_at")


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    keys: Sequence[str],
    sticky: Sequence[str],
    mutable: Sequence[str],
) -> None:
    """Fold all batches into one base folder of a new table; the old one stays untouched."""
    rows = spark.read.parquet(path)
    base = flat_states(fold_states(rows, keys, sticky, mutable), keys, sticky, mutable)
    base.write.mode("errorifexists").parquet(f"{new_path}/batch=-1")


def start_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    sticky: Sequence[str],
    mutable: Sequence[str],
    order: Sequence[str],
) -> StreamingQuery:
    """Load everything that is available now, then stop."""
    return (
        stream.writeStream.foreachBatch(upsert_batch(path, keys, sticky, mutable, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_distinct(
    stream: DataFrame, path: str, checkpoint: str, ids: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """Store each micro-batch with the first version of every id in it, then stop.

    No row is too late: an item never seen before counts however old it is.  So no
    watermark is used and no state is kept; ``distinct_items`` settles copies across
    batches on read.
    """
    columns = [c for c in stream.columns if c not in ids]
    return start_upsert(stream, path, checkpoint, ids, columns, [], order)


def distinct_items(spark: SparkSession, path: str, ids: Sequence[str]) -> DataFrame:
    """The first version of every id over all stored batches."""
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c not in {*ids, "_first_at", "_last_at", "batch"}]
    return upserted(spark, path, ids, columns, [])


def daily_totals(items: DataFrame, on: str, amount: str, by: Sequence[str]) -> DataFrame:
    """Count and sum per day and ``by`` columns of distinct items; items without a date have a null day."""
    day = F.col(on).cast("date").alias("day")
    return items.groupBy(day, *by).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"))
