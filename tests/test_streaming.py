from datetime import date, datetime

from pyspark.sql import functions as F

from arrearium.operators import fold
from arrearium.session import scratch_path
from arrearium.streaming import jobs
from conftest import rows

SCHEMA = "key string, seq int, sticky string, mutable string"


def stream(spark, path, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_upsert_equals_batch_fold_and_survives_replay(spark):
    data = [(f"k{i % 40}", i, f"s{i}", None if i % 7 == 0 else f"m{i}") for i in range(400)]
    df = spark.createDataFrame(data, SCHEMA)
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    df.repartition(5).write.parquet(src)
    args = (["key"], ["sticky"], ["mutable"])
    jobs.start_upsert(stream(spark, src), out, ckpt, *args, ["seq"]).awaitTermination()
    want = rows(fold.fold_versions(df, ["key"], ["mutable"], ["seq"]).select("key", "sticky", "mutable"))
    assert rows(jobs.upserted(spark, out, *args)) == want
    # the same rows arrive again
    df.write.mode("append").parquet(src)
    jobs.start_upsert(stream(spark, src), out, ckpt, *args, ["seq"]).awaitTermination()
    assert rows(jobs.upserted(spark, out, *args)) == want
    packed = scratch_path(spark, "packed")
    jobs.compact(spark, out, packed, *args)
    assert rows(jobs.upserted(spark, packed, *args)) == want
    assert spark.read.parquet(packed).count() == 40


def test_a_retried_batch_replaces_itself(spark):
    out = scratch_path(spark, "retry")
    write = jobs.upsert_batch(out, ["key"], ["sticky"], ["mutable"], ["seq"])
    df = spark.createDataFrame([("k", 1, "s", "m")], SCHEMA)
    write(df, 0)
    write(df, 0)
    assert spark.read.parquet(out).count() == 1


def test_items_never_seen_before_count_however_late(spark):
    schema = "id int, ts timestamp, amount int"
    late = [(i, datetime(2024, 1, 1 + i // 10, 12), 1) for i in range(30)]
    again = [(i, datetime(2024, 2, 1), 7) for i in range(5)]  # later copies of old items
    src, out, ckpt = (scratch_path(spark, n) for n in "abc")
    for batch in ([(99, datetime(2024, 1, 20, 1), 5), (98, None, 2)], late[20:], late[:20] + again):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        events = spark.readStream.schema(schema).parquet(src)
        jobs.start_distinct(events, out, ckpt, ["id"], ["ts"]).awaitTermination()
    items = jobs.distinct_items(spark, out, ["id"])
    assert items.columns == ["id", "ts", "amount"]
    assert rows(jobs.daily_totals(items, "ts", "amount", [])) == sorted(
        [(date(2024, 1, 1), 10, 10), (date(2024, 1, 2), 10, 10), (date(2024, 1, 3), 10, 10), (date(2024, 1, 20), 1, 5)]
        + [(None, 1, 2)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_streamed_files_are_bounded_and_batches_fixed(spark, monkeypatch):
    from types import SimpleNamespace

    from catalog import streams

    made = []
    monkeypatch.setattr(streams, "FILE_ROWS", 100, raising=False)
    monkeypatch.setattr(streams, "scratch_path", lambda session, name: made.append(scratch_path(session, name)) or made[-1])
    stream = streams._as_files(SimpleNamespace(spark=spark), spark.range(1000), "rows")
    rows = spark.read.parquet(made[0]).groupBy(F.input_file_name()).count()
    assert stream.isStreaming and rows.count() == 12 and rows.where("count > 100").count() == 0
