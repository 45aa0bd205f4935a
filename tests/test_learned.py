"""Learned date orders, merged distinct counts and watermarks from footers against plain programs."""

import random
from datetime import date, datetime

import pytest

from arrearium.operators import distinct
from arrearium.operators.learned import learn_formats, with_learned_dates
from arrearium.session import scratch_path
from arrearium.sources import ingest


def dates(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    return [r.t for r in with_learned_dates(df, ["t"]).orderBy("i").collect()]


def test_one_row_settles_the_column(spark):
    assert dates(spark, ["03/04/2021", "13/04/2021"]) == [datetime(2021, 4, 3), datetime(2021, 4, 13)]
    assert dates(spark, ["03/04/2021", "04/13/2021 10:20:30"]) == [datetime(2021, 3, 4), datetime(2021, 4, 13, 10, 20, 30)]
    assert dates(spark, ["03/04/2021"]) == [datetime(2021, 3, 4)]
    # No order reads all: each value by the first that makes it a date.
    assert dates(spark, ["03/04/2021", "13/04/2021", "04/13/2021"]) == [datetime(2021, 3, 4), datetime(2021, 4, 13), datetime(2021, 4, 13)]
    # Separators are settled one by one; impossible dates and other texts say nothing.
    got = dates(spark, ["03/04/2021", "25.12.2020", "01.02.2020", "31/31/2021", "2020-02-30", "2020-02-03", "N/A", None, "", "x", "30/02/2021", "5-6-2021", "1/2-2021"])
    assert got == [
        datetime(2021, 3, 4), datetime(2020, 12, 25), datetime(2020, 2, 1), None, None, datetime(2020, 2, 3), None, None, None, None, None,
        datetime(2021, 5, 6), None,
    ]
    none = spark.createDataFrame([], "t string, `a.b` string")
    assert learn_formats(none, ["t"]).first().t == [None, None, None] and with_learned_dates(none, ["t"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_columns_come_back(spark, seed):
    r = random.Random(seed)
    days = [date(2000 + r.randrange(30), r.randint(1, 12), r.randint(1, 28)) for _ in range(60)] + [date(2011, 5, 27)]
    order, sep = (("%d", "%m"), ("%m", "%d"))[seed % 2], "/-."[seed]
    assert [x.date() for x in dates(spark, [d.strftime(f"{order[0]}{sep}{order[1]}{sep}%Y") for d in days])] == days


def test_numbers_never_change_and_counts_merge(spark):
    r = random.Random(5)
    rows = [(day, r.choice([None, *[f"id{r.randrange(60 * day)}" for _ in range(9)]])) for day in range(1, 8) for _ in range(200)]
    df = spark.createDataFrame(rows, "day int, id string")
    path, bitmaps = scratch_path(spark, "dictionary"), scratch_path(spark, "bitmaps")
    known = None
    for day in range(1, 8):  # day by day, old slices are not touched
        part = df.where(f"day = {day}")
        before = {} if known is None else {x.id: x.number for x in known.collect()}
        distinct.number_ids(part, "id", known).write.mode("append").parquet(path)
        known = spark.read.parquet(path)
        now = {x.id: x.number for x in known.collect()}
        assert before.items() <= now.items() and len(set(now.values())) == len(now)
        distinct.slice_bitmaps(part, known, "id", ["day"]).write.mode("append").parquet(bitmaps)
    stored = spark.read.parquet(bitmaps)
    ids = [(d, i) for d, i in rows if i is not None]
    for low, high in ((1, 7), (2, 3), (6, 6)):
        got = distinct.merged_count(stored.where(f"day BETWEEN {low} AND {high}"), [], "n").first().n
        assert got == len({i for d, i in ids if low <= d <= high})
    by_day = {x.day: x.n for x in distinct.merged_count(stored, ["day"], "n").collect()}
    assert by_day == {d: len({i for e, i in ids if e == d}) for d in range(1, 8)}
    assert distinct.merged_count(stored.where("day > 99"), [], "n").first().n == 0
    plan = distinct.merged_count(stored, [], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_footers_tell_the_newest_date_and_other_types_are_scanned(spark):
    path = scratch_path(spark, "dates")
    spark.createDataFrame([(date(2024, 1, k), datetime(2024, 2, k, 5), k) for k in range(1, 9)], "d date, t timestamp, n int").repartition(3).write.parquet(path)
    found = ingest.newest_in_footers(spark, path, ["d", "n"])
    assert tuple(found.first()) == (date(2024, 1, 8), 8)
    assert "PushedAggregation: [MAX(d), MAX(n)]" in found._jdf.queryExecution().executedPlan().toString()
    scanned = ingest.newest_in_footers(spark, path, ["d", "t"])
    assert tuple(scanned.first()) == (date(2024, 1, 8), datetime(2024, 2, 8, 5))
    assert ingest.watermark_from_footers(spark, path, ["d"]).first().watermark == date(2024, 1, 7)
    assert ingest.watermark_from_footers(spark, path, ["d", "t"]).first().watermark == date(2024, 2, 7)
    empty = scratch_path(spark, "none")
    spark.createDataFrame([], "d date").write.parquet(empty)
    assert ingest.watermark_from_footers(spark, empty, ["d"]).first().watermark == date(1969, 12, 31)
    assert ingest.watermark_from_footers(spark, empty, ["d"], epoch_when_empty=False, default_start="2023-01-01").first().watermark == date(2023, 1, 1)


def test_values_are_split_once_and_impossible_ones_are_not_tried(spark):
    df = spark.createDataFrame([("13/04/2021", "1.2.2021 23:59:60"), ("1/31/2021", "31.12.2021 24:00:00")], "t string, u string")
    read = with_learned_dates(df, ["t", "u"])
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    # Per column one split for learning and one for reading, with the copy of the subquery's plan that Spark prints.
    assert plan.count("split(") <= 6
    assert sorted(r.t for r in read.collect()) == [datetime(2021, 1, 31), datetime(2021, 4, 13)]
    assert {r.u for r in read.collect()} == {datetime(2021, 1, 3), None}
