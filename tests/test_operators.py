import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from arrearium.functions import dates as da
from arrearium.operators import asof, fold, joins, slices, windows
from arrearium.session import scratch_path
from conftest import rows

# ---- folds -------------------------------------------------------------------------

VERSIONS = [
    # key, seq, sticky, mutable
    ("k", 1, "first", "a"),
    ("k", 2, "changed", "b"),
    ("k", 3, "again", None),
    ("other", 1, None, "x"),
    ("other", 2, "late", "y"),
]
SCHEMA = "key string, seq int, sticky string, mutable string"


def folded(df):
    return rows(fold.fold_versions(df, ["key"], ["mutable"], ["seq"]).select("key", "sticky", "mutable"))


def test_sticky_keeps_first_and_mutable_takes_last_even_null(spark):
    assert folded(spark.createDataFrame(VERSIONS, SCHEMA)) == [("k", "first", None), ("other", None, "y")]


def test_replay_changes_nothing(spark):
    once = spark.createDataFrame(VERSIONS, SCHEMA)
    assert folded(once.unionByName(once)) == folded(once)


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    assert folded(df.repartition(7)) == folded(df.coalesce(1)) == folded(df.orderBy(F.rand(1)))


def test_batch_times(spark):
    df = spark.createDataFrame([("k", 1, "s", "m", 10), ("k", 2, "s", "m", 20)], SCHEMA + ", at int")
    r = fold.fold_versions(df, ["key"], ["mutable"], ["seq"], "at").first()
    assert (r.loaded_at, r.updated_at) == (10, 20)


def test_upsert_in_one_pass_equals_touched_only(spark):
    rng = random.Random(4)
    target = spark.createDataFrame([(f"k{i}", "old", f"m{i}") for i in range(200)], "key string, sticky string, mutable string")
    batch = spark.createDataFrame(
        [(f"k{rng.randrange(150, 260)}", s, "new", rng.choice(["n", None])) for s in range(120)],
        "key string, seq int, sticky string, mutable string",
    )
    a = fold.upsert(target, batch, ["key"], ["mutable"], ["seq"])
    b = fold.upsert_touched(target, batch, ["key"], ["mutable"], ["seq"])
    assert rows(a) == rows(b)
    assert {r[1] for r in rows(a) if int(r[0][1:]) < 200} == {"old"}
    again = fold.upsert(a, batch, ["key"], ["mutable"], ["seq"])
    assert rows(again) == rows(a)


def test_keep_last_first_and_latest_with_nulls_last(spark):
    df = spark.createDataFrame([("k", None, "n"), ("k", 1, "a"), ("k", 3, "c"), ("z", None, "only")], "key string, d int, v string")
    assert rows(fold.keep_last(df.filter("d is not null"), ["key"], ["d"])) == [("k", 3, "c")]
    assert rows(fold.keep_first(df.filter("d is not null"), ["key"], ["d"])) == [("k", 1, "a")]
    assert rows(fold.latest_per_key(df, ["key"], F.col("d"), ["v"])) == [("k", 3, "c"), ("z", None, "only")]


def test_insert_ignore(spark):
    target = spark.createDataFrame([("a", 1)], "key string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 2), ("b", 1)], "key string, v int")
    assert rows(fold.insert_ignore(target, batch, ["key"], ["v"])) == [("b", 1)]


# ---- as-of -------------------------------------------------------------------------


def month_ends(first, last):
    return [(m.replace(day=1), m) for m in da.month_end_list(first, last)]


def brute(data, first, last, lookback, grace):
    out = []
    for start, end in month_ends(first, last):
        best = {}
        for key, d, v in data:
            if d > end + timedelta(days=grace):
                continue
            if lookback is not None and d < start - timedelta(days=lookback):
                continue
            if key not in best or (d, v) > best[key]:
                best[key] = (d, v)
        out += [(start, end, k, d, v) for k, (d, v) in best.items()]
    return sorted(out, key=lambda r: tuple(str(x) for x in r))


def run(spark, data, first, last, lookback=None, grace=0):
    df = spark.createDataFrame(data, "key string, d date, v int")
    got = asof.asof_month_ends(df, "key", "d", first, last, lookback, grace, tie=["v"])
    return rows(got.select("month_start", "month_end", "key", "d", "v"))


@pytest.mark.parametrize("lookback, grace", [(45, 0), (45, 3), (None, 0), (None, 3), (10, 0), (100, 10)])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_equals_brute_force(spark, lookback, grace, seed):
    rng = random.Random(seed)
    data = [(f"k{rng.randrange(6)}", date(2023, 6, 1) + timedelta(days=rng.randrange(500)), i) for i in range(120)]
    # one key holds a third of the rows
    data += [("hot", date(2023, 6, 1) + timedelta(days=rng.randrange(500)), i) for i in range(60)]
    first, last = date(2023, 12, 1), date(2024, 6, 30)
    assert run(spark, data, first, last, lookback, grace) == brute(data, first, last, lookback, grace)


def test_asof_edges(spark):
    first = last = date(2024, 2, 1)
    end = date(2024, 2, 29)
    on = lambda d, **k: [r[3] for r in run(spark, [("k", d, 1)], first, last, **k)]
    assert on(end, lookback=45) == [end]
    assert on(end + timedelta(days=1), lookback=45) == []
    assert on(end + timedelta(days=3), lookback=45, grace=3) == [end + timedelta(days=3)]
    assert on(end + timedelta(days=4), lookback=45, grace=3) == []
    assert on(first - timedelta(days=45), lookback=45) == [first - timedelta(days=45)]
    assert on(first - timedelta(days=46), lookback=45) == []
    assert on(date(1999, 1, 1)) == [date(1999, 1, 1)]


def test_asof_ties_on_one_day_are_settled(spark):
    assert [r[4] for r in run(spark, [("k", date(2024, 2, 3), v) for v in (1, 3, 2)], "2024-02-01", "2024-02-29")] == [3]


def test_asof_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "snaps")
    spark.range(400).select(
        F.col("id").cast("string").alias("key"), F.col("id").alias("v"), F.lit("drop me").alias("unused"),
        F.expr("date_add(DATE '2023-01-01', cast(id as int))").alias("d"),
    ).write.partitionBy("d").parquet(path)
    df = spark.read.parquet(path).select("key", "d", "v")
    plan = asof.asof_month_ends(df, "key", "d", "2024-01-01", "2024-01-31", 45)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "(d#" in plan and "2023-11-17" in plan and "2024-02-01" in plan
    assert "unused" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_until(spark):
    df = spark.createDataFrame([("k", date(2024, 1, 1), 1), ("k", date(2024, 2, 1), 2), ("j", date(2024, 3, 1), 3)], "key string, d date, v int")
    assert rows(asof.latest_until(df, "key", "d", "2024-02-01")) == [("k", date(2024, 2, 1), 2)]


# ---- joins and windows ---------------------------------------------------------------


def test_not_in_follows_sql_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    lists = {n: spark.createDataFrame(v, "m string") for n, v in {"plain": [("a",)], "null": [("a",), (None,)], "empty": []}.items()}
    assert rows(joins.not_in(df, lists["plain"], "k", "m")) == [("b",)]
    assert rows(joins.not_in(df, lists["null"], "k", "m")) == []
    assert rows(joins.not_in(df, lists["empty"], "k", "m")) == [("a",), ("b",), (None,)]
    assert rows(joins.not_listed(df, lists["null"], "k", "m")) == [("b",), (None,)]


def test_mark(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    assert rows(joins.mark(df, members, "k", "m", "hit")) == [("a", True), ("b", False), (None, False)]


def test_primary_else_fallback(spark):
    p = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    f = spark.createDataFrame([("a", 9), ("b", 9), ("c", 9), (None, 9)], "k string, v int")
    assert rows(joins.primary_else_fallback(p, f, "k", ["v"])) == [("a", 1), ("b", None), ("c", 9)]
    assert rows(joins.first_known(p, f.filter("k is not null"), "k", "v", F.lit(0))) == [("a", 1), ("b", 9), ("c", 9)]


def test_match_rate(spark):
    facts = spark.createDataFrame([("a",)] * 3 + [("b",), (None,)], "k string")
    bridge = spark.createDataFrame([("a", "1"), ("b", "2")], "asset string, target string")
    targets = spark.createDataFrame([("1",)], "t string")
    r = joins.match_rate(facts, "k", bridge, "asset", "target", targets, "t").first()
    assert (r.matched, r.total, float(r.match_pct)) == (3, 5, 60.0)
    none = joins.match_rate(facts.limit(0), "k", bridge, "asset", "target", targets, "t").first()
    assert (none.matched, none.total, none.match_pct) == (0, 0, None)


def test_spread_join_splits_a_hot_key_and_keeps_every_pair(spark):
    facts = [(i, "hot" if i % 3 == 0 else f"k{i % 500}") for i in range(3000)] + [(9001, None), (9002, "unknown")]
    dim = [(f"k{i}", f"v{i}") for i in range(500)] + [("hot", "v1"), ("hot", "v2"), (None, "v0")]
    f = spark.createDataFrame(facts, "id int, k string")
    d = spark.createDataFrame(dim, "dk string, v string")
    got = joins.spread_join(f, d, "k", "dk", "id")
    assert got.columns == ["id", "k", "dk", "v"]
    plain = f.join(d, F.col("k") == F.col("dk"))
    assert rows(got) == rows(plain)
    assert joins.spread_join(f.limit(0), d, "k", "dk", "id").count() == 0


def test_mark_first_and_running_total_with_a_hot_key(spark):
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else f"k{i % 17}", date(2024, 1, 1) + timedelta(days=rng.randrange(90)), i % 10) for i in range(900)]
    df = spark.createDataFrame(data, "id int, key string, d date, amount int")
    got = {r.id for r in windows.mark_first(df, "key", "id", ["d"], "first").filter("first").collect()}
    want = {}
    for i, key, d, _ in data:
        if key not in want or (d, i) < want[key]:
            want[key] = (d, i)
    assert got == {i for _, i in want.values()}
    total = {(r.key, r.month_start): r.total for r in windows.monthly_running_total(df, "key", "d", "amount", "total").collect()}
    for (key, month), value in total.items():
        assert value == sum(a for _, k, d, a in data if k == key and d.replace(day=1) <= month)


# ---- slices ----------------------------------------------------------------------------


def test_replace_slice_leaves_the_others(spark):
    path = scratch_path(spark, "slices")
    df = spark.createDataFrame([(date(2024, 1, d), d) for d in (1, 2, 3)], "day date, v int")
    slices.append_slices(df, path, "day")
    new = spark.createDataFrame([(date(2024, 1, 2), 20), (date(2024, 1, 2), 21), (date(2024, 1, 9), 9)], "day date, v int")
    for _ in range(2):
        assert slices.replace_slice(new, path, "day", "2024-01-02") == 2
    assert rows(spark.read.parquet(path).select("day", "v")) == [
        (date(2024, 1, 1), 1), (date(2024, 1, 2), 20), (date(2024, 1, 2), 21), (date(2024, 1, 3), 3)
    ]
    assert slices.replace_slice(new.limit(0), path, "day", "2024-01-02") == 0
    assert rows(spark.read.parquet(path).select("v")) == [(1,), (3,)]
    assert slices.read_slice(spark, path, "day", "2024-01-03").count() == 1


def test_missing_slices_over_year_end_and_leap_february(spark):
    cal = da.calendar(spark, "2023-11-15", "2024-03-10")
    assert rows(cal.select("month_end")) == [(d,) for d in (date(2023, 11, 30), date(2023, 12, 31), date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31))]
    done = spark.createDataFrame([(date(2023, 12, 31),), (date(2024, 2, 29),)], "day date")
    left = slices.missing_slices(cal, "month_end", done, "day")
    assert rows(left.select("month_end")) == [(date(2023, 11, 30),), (date(2024, 1, 31),), (date(2024, 3, 31),)]
    assert da.month_end_list("2024-12-05", "2025-02-01") == [date(2024, 12, 31), date(2025, 1, 31), date(2025, 2, 28)]
    assert da.calendar(spark, "2024-03-01", "2024-02-01").count() == 0


def test_union_versions(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "n")], "x int, y string")
    assert rows(slices.union_versions(a, b)) == [(1, None), (2, "n")]


def test_null_dates_come_last_and_count_in_no_month(spark):
    data = [("k", "a", None, 100), ("k", "b", date(2024, 1, 5), 1), ("k", "c", date(2024, 1, 5), 2), ("n", "d", None, 3)]
    df = spark.createDataFrame(data, "key string, id string, d date, amount int")
    firsts = {r.id for r in windows.mark_first(df, "key", "id", ["d"], "first").filter("first").collect()}
    assert firsts == {"b", "d"}
    totals = windows.monthly_running_total(df, "key", "d", "amount", "total").collect()
    assert [(r.key, r.month_start, r.total) for r in totals] == [("k", date(2024, 1, 1), 3)]
