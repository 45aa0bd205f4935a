"""Joins beyond the plain equi-join: mark, anti, bridge, fallback, reconciliation.

No join here forces a broadcast: Catalyst and AQE broadcast a side when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it otherwise.
Fact rows are summed to one row per key before they meet a dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.session import scratch_path


def mark(df: DataFrame, members: DataFrame, key: str, member_key: str, name: str) -> DataFrame:
    """Add a boolean column: is ``key`` in the member list?  Null keys are not."""
    listed = (
        members.select(F.col(member_key).alias("_member"))
        .filter(F.col("_member").isNotNull())
        .distinct()
    )
    return (
        df.join(listed, F.col(key) == F.col("_member"), "left")
        .withColumn(name, F.col("_member").isNotNull())
        .drop("_member")
    )


def not_listed(df: DataFrame, members: DataFrame, key: str, member_key: str) -> DataFrame:
    """Rows whose key is not in the list; null keys stay, null members are ignored."""
    listed = members.select(F.col(member_key).alias("_member"))
    return df.join(listed, F.col(key) == F.col("_member"), "left_anti")


def not_in(df: DataFrame, members: DataFrame, key: str, member_key: str) -> DataFrame:
    """SQL ``NOT IN`` with its null rules, as a shuffled anti join.

    An empty list keeps every row; a null in the list removes every row; a null key
    is removed unless the list is empty.  The list's two facts (any row, any null) are
    one-row scalar subqueries, so a long list is not broadcast.
    """
    facts = members.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count(F.col(member_key)).alias("n_set"),
        ).alias("f")
    )
    f = facts.scalar()
    empty = f.getField("n") == 0
    no_null = f.getField("n") == f.getField("n_set")
    kept = not_listed(df, members, key, member_key)
    return kept.filter(empty | (no_null & F.col(key).isNotNull()))


# A key is hot when it holds more than 1 / HOT_SHARE of the rows, so there are fewer than
# HOT_SHARE hot keys whatever the data.  Each is cut into HOT_PARTS parts.
HOT_SHARE = 200
HOT_PARTS = 200


def spread_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    row_id: str,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Inner join of fact rows to a dimension, with hot keys spread over many tasks.

    Rows of a hot key are dealt to parts by a hash of ``row_id`` and the dimension rows
    of that key are copied to every part.  Other keys join as usual.  The list of hot
    keys has fewer than ``HOT_SHARE`` rows by definition, so broadcasting it is safe.
    ``counts`` (``fact_key``, ``n``), stored by the caller, saves the counting pass; else
    the counts are stored here, since three steps read them.
    """
    n = counts
    if n is None:
        path = scratch_path(facts.sparkSession, "counts")
        facts.groupBy(fact_key).agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
        n = facts.sparkSession.read.parquet(path)
    total = n.agg(F.sum("n")).scalar()
    hot = F.broadcast(
        n.filter(F.col("n") * HOT_SHARE > total).select(F.col(fact_key).alias("_hot"))
    )
    parts = (
        facts.join(hot, F.col(fact_key) == F.col("_hot"), "left")
        .withColumn(
            "_part",
            F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(row_id), F.lit(HOT_PARTS)).cast("int")).otherwise(0),
        )
        .drop("_hot")
    )
    every = F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))
    copies = (
        dim.join(hot, F.col(dim_key) == F.col("_hot"), "left")
        .withColumn("_copy", F.explode(F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    on = (F.col(fact_key) == F.col(dim_key)) & (F.col("_part") == F.col("_copy"))
    return parts.join(copies, on, "inner").drop("_part", "_copy")


def bridge_sums(
    facts: DataFrame,
    fact_key: str,
    bridge: DataFrame,
    bridge_key: str,
    bridge_target: str,
    by: Sequence[str],
    sums: Sequence[str],
) -> DataFrame:
    """Sum facts per bridged target (fact key -> bridge -> target) and ``by`` columns.

    Facts collapse to one row per (key, by) before the join, so a hot fact key is one
    row per group when it meets the bridge.
    """
    small = facts.groupBy(F.col(fact_key).alias("_key"), *by).agg(*[F.sum(s).alias(s) for s in sums])
    link = bridge.select(
        F.col(bridge_key).alias("_link"), F.col(bridge_target).cast("string").alias(bridge_target)
    )
    return (
        small.join(link, F.col("_key") == F.col("_link"), "inner")
        .groupBy(bridge_target, *by)
        .agg(*[F.sum(s).alias(s) for s in sums])
    )


def primary_else_fallback(
    primary: DataFrame, fallback: DataFrame, key: str, measures: Sequence[str]
) -> DataFrame:
    """Rows of ``primary`` plus the ``fallback`` rows whose key the primary lacks.

    Both sides have one row per key.  One grouping on the key decides, instead of an
    anti join and a second pass over the primary.
    """
    cols = [F.struct(*measures).alias("_m")]
    both = primary.select(key, F.lit(1).alias("_rank"), *cols).unionByName(
        fallback.filter(F.col(key).isNotNull()).select(key, F.lit(0).alias("_rank"), *cols)
    )
    return both.groupBy(key).agg(F.max_by("_m", "_rank").alias("_m")).select(key, "_m.*")


def first_known(
    primary: DataFrame, fallback: DataFrame, key: str, measure: str, default: Column
) -> DataFrame:
    """Full outer variant: per key the primary's value, else the fallback's, else a default."""
    p = primary.select(key, F.col(measure).alias("_p"))
    f = fallback.select(key, F.col(measure).alias("_f"))
    return p.join(f, key, "full_outer").select(key, F.coalesce("_p", "_f", default).alias(measure))


def match_rate(
    facts: DataFrame,
    fact_key: str,
    bridge: DataFrame,
    bridge_key: str,
    bridge_target: str,
    targets: DataFrame,
    target_key: str,
) -> DataFrame:
    """One row: facts that reach a target through the bridge, all facts, percent."""
    per_key = facts.groupBy(F.col(fact_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    per_target = (
        bridge.select(F.col(bridge_key).alias("_link"), F.col(bridge_target).alias("_target"))
        .join(targets.select(F.col(target_key).alias("_t")), F.col("_target") == F.col("_t"), "inner")
        .groupBy("_link")
        .agg(F.count(F.lit(1)).alias("_hits"))
    )
    return (
        per_key.join(per_target, F.col("_key") == F.col("_link"), "left")
        .agg(
            F.coalesce(F.sum(F.col("_n") * F.col("_hits")), F.lit(0)).alias("matched"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        )
        .withColumn(
            "match_pct",
            F.round(
                (F.lit(100.0) * F.col("matched") / F.nullif(F.col("total"), F.lit(0))).cast("decimal(28,10)"), 1
            ),
        )
    )
