"""Streaming jobs run to completion over the given tables; the oracles are batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.session import scratch_path
from arrearium.streaming import jobs, levels
from catalog.folds import KEYS, MUTABLE, ORDER, STICKY_SQL
from catalog.registry import dbl, query, ts, txt
from catalog.tables import Tables, present

#: Micro-batches of a stream, and rows that one task writes into one file.
FILES, FILE_ROWS = 4, 1_000_000


def _as_files(t: Tables, df, name: str, batches: int = FILES):
    """The rows as a folder of files of bounded size, streamed in so many micro-batches of equally many files."""
    path = scratch_path(t.spark, name)
    each = max(1, -(-df.count() // (batches * FILE_ROWS)))
    df.repartition(batches * each).write.parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", each).parquet(path)


def _pulls(t: Tables, df, on: str, name: str, cuts: list[str]):
    """Land the rows pull by pull, newest days first, and hand out the folder's stream after every landing.

    Each pull starts one day before its cut (the overlap of an incremental pull), and
    most rows come many days behind the newest one seen.
    """
    path = scratch_path(t.spark, name)
    bounds = [None, *cuts, None]
    for low, high in reversed(list(zip(bounds[:-1], bounds[1:], strict=True))):
        part = df
        if low:
            part = part.filter(F.col(on) >= F.lit(low).cast("timestamp") - F.expr("INTERVAL 1 DAY"))
        if high:
            part = part.filter(F.col(on) < F.lit(high).cast("timestamp"))
        part.write.mode("append").parquet(path)
        yield t.spark.readStream.schema(df.schema).parquet(path)


CUTS = ["2024-01-11", "2024-01-21"]


def _distinct(t: Tables, events):
    out, checkpoint = scratch_path(t.spark, "distinct"), scratch_path(t.spark, "checkpoint")
    for stream in _pulls(t, events, "ts", "events", CUTS):
        jobs.start_distinct(stream, out, checkpoint, ["event_id"], ["ts"]).awaitTermination()
    return jobs.distinct_items(t.spark, out, ["event_id"])


@query("stream_upsert", STICKY_SQL.replace("loaded_at", "first_seen").replace("updated_at", "last_seen"))
def stream_upsert(t: Tables):
    versions = t.versions.withColumn("first_seen", F.col("seen_on").cast("timestamp")).withColumn(
        "last_seen", F.col("first_seen")
    )
    stream = _as_files(t, versions, "versions")
    table = scratch_path(t.spark, "upserts")
    sticky, mutable = ["l_partkey", "quantity", "kind", "first_seen"], [*MUTABLE, "last_seen"]
    jobs.start_upsert(
        stream, table, scratch_path(t.spark, "checkpoint"), KEYS, sticky, mutable, ORDER
    ).awaitTermination()
    return present(jobs.upserted(t.spark, table, KEYS, sticky, mutable))


@query(
    "stream_dedup",
    f"""SELECT event_id, {ts('ts')} AS ts, asset_id, event_type, {dbl('amount')} AS amount FROM fx_events""",
)
def stream_dedup(t: Tables):
    return present(_distinct(t, t.fx_events.select("event_id", "ts", "asset_id", "event_type", "amount")))


@query(
    "stream_daily_totals",
    f"""SELECT {txt('ts')} AS day, event_type, count(*) AS n, {dbl('sum(amount)')} AS total FROM fx_events GROUP BY 1, 2""",
)
def stream_daily_totals(t: Tables):
    items = _distinct(t, t.fx_events.select("event_id", "ts", "event_type", "amount"))
    return present(jobs.daily_totals(items, "ts", "amount", ["event_type"]))


BATCHES = 20


@query(
    "stream_compacted",
    f"""SELECT *, true AS few_folders FROM ({STICKY_SQL.replace("loaded_at", "first_seen").replace("updated_at", "last_seen")})""",
)
def stream_compacted(t: Tables):
    """Twenty micro-batches, merged by the stream as they come; a reader opens a few folders."""
    versions = t.versions.withColumn("first_seen", F.col("seen_on").cast("timestamp")).withColumn("last_seen", F.col("first_seen"))
    stream, table = _as_files(t, versions, "versions", BATCHES), scratch_path(t.spark, "levels")
    sticky, mutable = ["l_partkey", "quantity", "kind", "first_seen"], [*MUTABLE, "last_seen"]
    levels.start_upsert(stream, table, scratch_path(t.spark, "checkpoint"), KEYS, sticky, mutable, ORDER).awaitTermination()
    stored = levels.upsert_table(t.spark, table, KEYS, sticky, mutable)
    few = len(stored.segments()) <= 2 and sum(s.last - s.first + 1 for s in stored.segments()) == BATCHES
    return present(stored.read().drop("_first_at", "_last_at").withColumn("few_folders", F.lit(few)))


def _with_copies(t: Tables):
    """Every third event has a later copy with another amount; pulls bring the newest rows first, so copies come before."""
    events = t.fx_events.select("event_id", "ts", "event_type", "amount")
    copies = events.where("event_id % 3 = 0").withColumns(
        {"ts": F.expr("ts + INTERVAL 12 DAYS"), "amount": (F.col("amount") + 1).cast("decimal(18,2)")}
    )
    return events.unionByName(copies)


@query(
    "stream_totals_delta",
    f"""SELECT {txt('ts')} AS day, event_type, count(*) AS n, {dbl('sum(amount)')} AS total FROM fx_events GROUP BY 1, 2""",
)
def stream_totals_delta(t: Tables):
    """Totals kept by signed changes while copies come before the rows they are copies of."""
    out, checkpoint = scratch_path(t.spark, "totals"), scratch_path(t.spark, "checkpoint")
    for stream in _pulls(t, _with_copies(t), "ts", "events", CUTS):
        levels.start_totals(stream, out, checkpoint, ["event_id"], ["ts"], "ts", "amount", ["event_type"]).awaitTermination()
    return present(levels.totals(t.spark, out, ["event_type"]))


@query(
    "stream_dedup_pruned",
    f"""SELECT event_id, {ts('ts')} AS ts, event_type, {dbl('amount')} AS amount, true AS pruned FROM fx_events""",
)
def stream_dedup_pruned(t: Tables):
    """Distinct items whose batches look up only the buckets that may hold one of their ids."""
    out, checkpoint, looked = scratch_path(t.spark, "items"), scratch_path(t.spark, "checkpoint"), []
    for stream in _pulls(t, _with_copies(t), "ts", "events", ["2024-01-06", *CUTS, "2024-01-26"]):
        query = levels.start_distinct(stream, out, checkpoint, ["event_id"], ["ts"], lambda *x: looked.append(x))
        query.awaitTermination()
    read, present_ = (sum(x) for x in zip(*looked, strict=True))
    items = levels.seen_items(t.spark, out, ["event_id"], ["ts", "event_type", "amount"]).read().drop("_first_at", "_last_at")
    return present(items.withColumn("pruned", F.lit(read < present_)))
