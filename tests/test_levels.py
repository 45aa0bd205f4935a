"""Levelled folders, look-ups by marks and totals by changes against plain folds."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from arrearium.operators import fold
from arrearium.session import scratch_path
from arrearium.streaming import levels
from conftest import rows

SCHEMA = "key string, seq int, sticky string, mutable string"
ARGS = (["key"], ["sticky"], ["mutable"])


def some(seed, n=60):
    r = random.Random(seed)
    return [(f"k{r.randrange(30)}", seed + 100 * r.randrange(50), f"s{seed}-{i}", r.choice([None, f"m{i}"])) for i in range(n)]


def test_few_folders_after_many_batches_and_the_fold_of_all(spark):
    table = levels.upsert_table(spark, scratch_path(spark, "levels"), *ARGS, fan=3)
    every = []
    for batch in range(14):
        part = some(batch)
        every += part
        assert table.append(levels._placed(spark.createDataFrame(part, SCHEMA), ["seq"]), batch)
        spans = [(s.first, s.last) for s in table.segments()]
        assert spans[0][0] == 0 and spans[-1][1] == batch and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert max(Counter(s.level for s in table.segments()).values()) <= 2
    assert [s.level for s in table.segments()] == [2, 1, 0, 0]
    want = fold.fold_versions(spark.createDataFrame(every, SCHEMA), ["key"], ["mutable"], ["seq", "sticky"]).select("key", "mutable")
    got = table.read()
    assert rows(got.select("key")) == rows(want.select("key")) and got.count() == 30
    # A repeated batch is known by its number, also inside a merged folder.
    before = rows(got)
    for batch in (0, 5, 13):
        assert not table.append(levels._placed(spark.createDataFrame(some(99), SCHEMA), ["seq"]), batch)
    assert rows(table.read()) == before
    # Folders and manifests that nobody can hold any more are gone.
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/data")
    kept = folders.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folders)
    assert len(table.manifests.numbers()) <= table.keep and len(kept) < 14


def test_a_reader_keeps_its_manifest_while_folders_are_merged(spark):
    table = levels.upsert_table(spark, scratch_path(spark, "levels"), *ARGS, fan=2)
    table.append(levels._placed(spark.createDataFrame(some(0), SCHEMA), ["seq"]), 0)
    held = table.read()
    want = rows(held)
    for batch in (1, 2, 3):
        table.append(levels._placed(spark.createDataFrame(some(batch), SCHEMA), ["seq"]), batch)
    assert rows(held) == want and len(table.segments()) == 1


def test_stream_upsert_equals_batch_fold(spark):
    data = [(f"k{i % 40}", i, f"s{i}", None if i % 7 == 0 else f"m{i}") for i in range(400)]
    df = spark.createDataFrame(data, SCHEMA)
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    df.repartition(6).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    levels.start_upsert(stream, out, ckpt, *ARGS, ["seq"], fan=2).awaitTermination()
    want = rows(fold.fold_versions(df, ["key"], ["mutable"], ["seq"]).select("key", "sticky", "mutable"))
    assert rows(levels.upsert_table(spark, out, *ARGS).read().select("key", "sticky", "mutable")) == want


ITEM = "id long, ts timestamp, kind string, amount decimal(10,2)"
DAY = datetime(2024, 1, 1)


def item(i, day, amount, kind="a"):
    return (i, None if day is None else DAY + timedelta(days=day), kind, Decimal(amount))


def test_lookups_find_every_stored_id_and_read_few_buckets(spark):
    table = levels.seen_items(spark, scratch_path(spark, "seen"), ["id"], ["ts", "kind", "amount"], fan=10)
    for batch in range(5):
        part = spark.range(batch * 2000, (batch + 1) * 2000).selectExpr("id", "TIMESTAMP '2024-01-01' ts", "'a' kind", "cast(1 as decimal(10,2)) amount")
        table.append(levels._placed(part, ["ts"]), batch)
    asked = spark.createDataFrame([(i,) for i in [*range(0, 10_000, 97), *range(50_000, 50_040)]], "id long")
    found = table.lookup(asked)
    assert sorted(r.id for r in found.collect()) == list(range(0, 10_000, 97))
    assert table.present == 5 * levels.BUCKETS and table.looked < 0.6 * table.present
    table.looked = 0
    assert table.lookup(spark.createDataFrame([(i,) for i in range(60_000, 60_020)], "id long")) is None or table.looked < 8


def test_totals_follow_copies_that_come_before_their_originals(spark):
    r = random.Random(4)
    versions = [item(i, r.choice([None, *range(9)]), i + k, r.choice("ab")) for i in range(80) for k in range(r.choice([1, 1, 2, 3]))]
    r.shuffle(versions)
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    for k in range(0, len(versions), 30):
        spark.createDataFrame(versions[k : k + 30], ITEM).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).parquet(src)
        levels.start_totals(stream, out, ckpt, ["id"], ["ts", "amount"], "ts", "amount", ["kind"], fan=2).awaitTermination()
    first = {}
    for v in versions:
        place = (v[1] is not None, v[1] or DAY, v[3])  # nulls come first
        if v[0] not in first or place < first[v[0]][0]:
            first[v[0]] = (place, v)
    n, total = Counter(), Counter()
    for _, (_, ts, kind, amount) in first.values():
        day = ts.date() if ts else None
        n[day, kind] += 1
        total[day, kind] += amount
    got = levels.totals(spark, out, ["kind"])
    assert {(r.day, r.kind): (r.n, int(r.total)) for r in got.collect()} == {k: (n[k], total[k]) for k in n}
    assert got.inputFiles() and all("/changes/" in f for f in got.inputFiles())


def test_a_batch_that_failed_half_way_counts_once(spark, monkeypatch):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    args = (out, ckpt, ["id"], ["ts"], "ts", "amount", ["kind"])
    spark.createDataFrame([item(1, 0, 5), item(2, 1, 7)], ITEM).coalesce(1).write.parquet(src)

    def stream():
        return spark.readStream.schema(ITEM).parquet(src)

    def lost(self, rows, batch):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(levels.SeenItems, "append", lost)
        with pytest.raises(Exception, match="lost"):
            levels.start_totals(stream(), *args).awaitTermination()
    levels.start_totals(stream(), *args).awaitTermination()
    spark.createDataFrame([item(1, -3, 6)], ITEM).coalesce(1).write.mode("append").parquet(src)
    levels.start_totals(stream(), *args).awaitTermination()
    got = {(r.day, r.kind): (r.n, int(r.total)) for r in levels.totals(spark, out, ["kind"]).collect()}
    assert got == {(date(2023, 12, 29), "a"): (1, 6), (date(2024, 1, 2), "a"): (1, 7)}
    held = levels.seen_items(spark, f"{out}/items", ["id"], ["ts", "kind", "amount"]).read()
    assert sorted((r.id, int(r.amount)) for r in held.collect()) == [(1, 6), (2, 7)]
