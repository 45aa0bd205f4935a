"""Deduplication and upserts without MERGE.

An upsert is a fold: all versions of a key are grouped and the columns are taken
from the first or the last version.  ``min_by`` / ``max_by`` combine on the map side,
so one key with a third of all rows reaches the shuffle as one row per task.
``order`` must be a total order within a key; otherwise the result would depend on
how the input was split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rest(df: DataFrame, keys: Sequence[str], drop: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in drop]


def _pick(df: DataFrame, keys: Sequence[str], pick: Column) -> DataFrame:
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    return _pick(df, keys, F.max_by(F.struct(*_rest(df, keys)), F.struct(*order)))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``."""
    return _pick(df, keys, F.min_by(F.struct(*_rest(df, keys)), F.struct(*order)))


def keep_last_placed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_last`` of rows whose columns all have an order: place and columns travel as one value, so once."""
    return _pick(df, keys, F.max(F.struct(*order, *_rest(df, keys, order))))


def keep_first_placed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_first`` likewise."""
    return _pick(df, keys, F.min(F.struct(*order, *_rest(df, keys, order))))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Column, tie: Sequence[str]) -> DataFrame:
    """Newest row per key; a null ``newest`` sorts behind every value.

    Struct comparison puts nulls first, so taking the maximum gives nulls last.
    """
    rest = _rest(df, keys)
    return _pick(df, keys, F.max_by(F.struct(*rest), F.struct(newest.alias("_newest"), *tie)))


def fold_versions(
    versions: DataFrame,
    keys: Sequence[str],
    mutable: Sequence[str],
    order: Sequence[str],
    batch_time: str | None = None,
) -> DataFrame:
    """Upsert fold: ``mutable`` columns come from the last version (null included),
    every other column keeps the value it was first inserted with.

    With ``batch_time`` the result carries loaded_at / updated_at, the times of the
    first and the last version.
    """
    sticky = _rest(versions, keys, [*mutable, *order, *([batch_time] if batch_time else [])])
    at = F.struct(*order)
    aggs = []
    if sticky:
        aggs.append(F.min_by(F.struct(*sticky), at).alias("_first"))
    if mutable:
        aggs.append(F.max_by(F.struct(*mutable), at).alias("_last"))
    if batch_time:
        aggs += [F.min(batch_time).alias("loaded_at"), F.max(batch_time).alias("updated_at")]
    if not aggs:
        return versions.select(*keys).distinct()
    out = versions.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_first.{c}") for c in sticky]
    cols += [F.col(f"_last.{c}") for c in mutable]
    if batch_time:
        cols += [F.col("loaded_at"), F.col("updated_at")]
    return out.select(*cols)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    mutable: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Target (one row per key) after one batch, in a single shuffle.

    ``order`` columns exist in the batch only; stored rows come before all of them.
    """
    rank = F.lit(0).alias("_batch")
    stored = target.select(*target.columns, rank)
    fresh = batch.select(*target.columns, F.lit(1).alias("_batch"), *[F.col(c).alias(f"_o_{c}") for c in order])
    both = stored.unionByName(fresh, allowMissingColumns=True)
    folded = fold_versions(both, keys, mutable, ["_batch", *[f"_o_{c}" for c in order]])
    return folded.select(*target.columns)


def upsert_touched(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    mutable: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Same result as ``upsert`` for a batch that is small beside the target.

    Only the rows whose key occurs in the batch are folded; the others pass through.
    While the batch keys stay below the broadcast threshold the target is filtered in
    place and never shuffled; above it Spark falls back to a shuffled join.
    """
    touched = batch.select(*keys).distinct()
    same = target.join(touched, list(keys), "left_anti")
    changed = upsert(target.join(touched, list(keys), "left_semi"), batch, keys, mutable, order)
    return same.select(*target.columns).unionByName(changed)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The batch rows to append: the first row of every key the target lacks."""
    fresh = keep_first(batch, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti")


def fold_states(df: DataFrame, keys: Sequence[str], sticky: Sequence[str], mutable: Sequence[str]) -> DataFrame:
    """One row per key that can be folded again, from rows with the places ``_first_at`` and ``_last_at``.

    ``_first`` holds the first version's place and its ``sticky`` columns, ``_last`` the last one's and the ``mutable``
    ones.  Place and columns travel as one value whose order is that of the places, so a row carries each place once.
    """
    return df.groupBy(*keys).agg(
        F.min(F.struct("_first_at", *sticky)).alias("_first"), F.max(F.struct("_last_at", *mutable)).alias("_last")
    )


def flat_states(df: DataFrame, keys: Sequence[str], sticky: Sequence[str], mutable: Sequence[str]) -> DataFrame:
    """States with their columns side by side."""
    return df.select(
        *keys,
        *[F.col(f"_first.{c}").alias(c) for c in sticky],
        *[F.col(f"_last.{c}").alias(c) for c in mutable],
        F.col("_first._first_at").alias("_first_at"),
        F.col("_last._last_at").alias("_last_at"),
    )
