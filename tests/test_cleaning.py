import hashlib
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions import cleaning as cl
from arrearium.functions import jsonpath as js


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [("", None), (" ", None), ("nan", None), ("None", None), ("NULL", None), (" x ", "x"), ("\t x ", "x"), (None, None)],
)
def test_null_tokens(spark, raw, want):
    assert one(spark, raw, cl.clean_text) == want


def test_ledger_keeps_the_word_null(spark):
    assert one(spark, " null ", lambda c: cl.clean_text(c, values.LEDGER_NULL_TOKENS)) == "null"


@pytest.mark.parametrize(
    "raw, drop, want",
    [
        ("20,000", ", ", Decimal("20000.00")), ("1 000", ", ", Decimal("1000.00")), ("1 000", ",", None),
        ("$5", ",$", Decimal("5.00")), ("$5", ", ", None), ("abc", ", ", None), (None, ", ", None),
        ("1.005", ", ", Decimal("1.01")), ("1e3", ", ", Decimal("1000.00")), ("", ", ", None),
    ],
)
def test_numbers(spark, raw, drop, want):
    assert one(spark, raw, lambda c: cl.clean_number(c, drop)) == want


def test_ints_truncate(spark):
    assert one(spark, "12.9", cl.clean_int) == 12
    assert one(spark, "-12.9", cl.clean_int) == -12
    assert one(spark, "99999999999", cl.clean_int) is None


@pytest.mark.parametrize(
    "raw, formats, want",
    [
        ("2025-02-21T02:12:10.123Z", values.A_FORMATS, datetime(2025, 2, 21, 2, 12, 10, 123000)),
        ("2025-02-21T02:12:10.123456Z", values.A_FORMATS, datetime(2025, 2, 21, 2, 12, 10, 123456)),
        ("2025-02-21T02:12:10Z", values.A_FORMATS, datetime(2025, 2, 21, 2, 12, 10)),
        ("2025-2-1T02:12:10Z", values.A_FORMATS, datetime(2025, 2, 1, 2, 12, 10)),
        ("2025-02-21", values.A_FORMATS, None),
        ("2025-02-21", values.FORM_FORMATS, datetime(2025, 2, 21)),
        ("21-Feb-2025 02:12:10", values.TASK_FORMATS, datetime(2025, 2, 21, 2, 12, 10)),
        ("21-Feb-2025", values.TASK_FORMATS, datetime(2025, 2, 21)),
        ("21-Feb-2025", values.FORM_FORMATS, None),
        ("2025-02-21 02:12:10+0200", values.EVENT_FORMATS, datetime(2025, 2, 21, 0, 12, 10)),
        ("2025-02-21 02:12:10", values.EVENT_FORMATS, datetime(2025, 2, 21, 2, 12, 10)),
        ("2025-02-30", values.FORM_FORMATS, None),
        ("garbage", values.LENIENT_FORMATS, None),
        ("02/21/2025", values.LENIENT_FORMATS, datetime(2025, 2, 21)),
    ],
)
def test_dates(spark, raw, formats, want):
    got = one(spark, raw, lambda c: F.date_format(cl.parse_timestamp(c, formats), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert got == (want and want.strftime("%Y-%m-%d %H:%M:%S.%f"))


@pytest.mark.parametrize(
    "raw, want",
    [
        (" active ", "ENABLED"), ("AWAITING REMOVAL", "ENABLED"), ("disabled", "REPOSSESSED"), ("Locked", "LOCKED"),
        ("PaidOff", "PAID_OFF"), ("cancelled", "CANCELLED"), (" in review", "IN REVIEW"), (None, None),
    ],
)
def test_status(spark, raw, want):
    assert one(spark, raw, cl.normal_status) == want


def test_flags_and_deals(spark):
    assert [one(spark, v, cl.normal_flag) for v in (" Yes", "TRUE", "1", "no", None)] == ["true"] * 3 + ["false"] * 2
    assert [one(spark, v, cl.normal_deal) for v in ("no", "Yes ", "full", "lease", None)] == [
        "PAYG", "FULL", "FULL", "PAYG", "PAYG"
    ]
    assert [one(spark, v, cl.lookup_deal) for v in ("yes", "NO", " lease ", "nan", None)] == [
        "FULL", "PAYG", "lease", None, None
    ]


def test_names(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), ("a", None), (None, ""), ("Contest", "b")], "f string, l string")
    got = df.select(cl.full_name(F.col("f"), F.col("l")), cl.is_test_name(F.col("f"), F.col("l"))).collect()
    assert [r[0] for r in got] == ["a b", "b", "a", None, "Contest b"]
    assert [r[1] for r in got] == [False, False, False, False, True]


@pytest.mark.parametrize(
    "raw, want",
    [
        ('{"agent": {"agentNumber": "1"}}', "1"), ('{"agent": {"id": "3"}}', "3"), ('{"agent": "2"}', "2"),
        ('{"agent": null, "assignedTo": "4"}', "4"), ('{"agent": {}}', None), ('{"agent": {}, "assignedTo": "5"}', "5"),
        ("{}", None),
    ],
)
def test_object_or_text(spark, raw, want):
    got = one(
        spark, raw,
        lambda c: js.object_or_text(("agentNumber", "number", "id"), js.json_text(c, "agent"), js.json_text(c, "assignedTo")),
    )
    assert got == want


def test_first_path_skips_blank_values_and_reads_lists(spark):
    raw = '{"a": {"b": ["x", "y"]}, "c": "", "d": [], "e": "z"}'
    assert one(spark, raw, lambda c: js.first_path(c, "c", "d", "e")) == "z"
    assert one(spark, raw, lambda c: js.first_path(c, "a.b.1")) == "y"
    assert one(spark, raw, lambda c: js.first_path(c, "missing", "d")) is None


def test_surrogate_key_counts_null_as_blank(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    got = df.select(js.surrogate_key(F.col("x"), F.col("y"), F.col("z"))).first()[0]
    assert got == hashlib.sha1(b"a||||c").hexdigest()
