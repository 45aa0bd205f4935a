"""Date formats learned from whole columns.

A text such as 03/04/2021 does not say whether the day or the month comes first; the column usually does, since some
row has a number above 12.  Each value gives a bit mask of the orders that read it; the masks of all values with one
separator are combined by ``bit_and``, partly in each task, so a column is settled in one pass however long it is.

If both orders read every value the first holds (month first, as the fixed list has it).
If none reads all, the column mixes orders, and each value is read by the first order that makes it a date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.functions.cleaning import clean_text, parse_timestamp
from arrearium.values import LENIENT_FORMATS

#: Texts that can be read in two orders: two numbers, a year, and perhaps a time; a column is settled per separator.
SEPARATORS = ("/", "-", ".")
_SHAPE = r"^\d{1,2}([/.-])\d{1,2}\1\d{4}( \d{1,2}:\d{1,2}:\d{1,2})?$"
MONTH_FIRST, DAY_FIRST = 1, 2


def _readings(text: Column) -> Column:
    """Both readings of a text of the shape: month first and day first, each null if there is no such date."""
    n = F.transform(F.split(text, "[/. :-]"), lambda x: x.cast("int"))

    def read(x: Column) -> Column:
        clock = [F.coalesce(F.get(x, F.lit(k)), F.lit(0)) for k in (3, 4, 5)]
        year, first, second = F.get(x, F.lit(2)), F.get(x, F.lit(0)), F.get(x, F.lit(1))
        in_range = (clock[0] <= 23) & (clock[1] <= 59) & (clock[2] <= 60)

        def made(month: Column, day: Column) -> Column:
            # Ranges first: a failed make costs an exception per row, and most days are above 12.
            return F.when(in_range & month.between(1, 12) & day.between(1, 31), F.try_make_timestamp(year, month, day, *clock))

        return F.struct(made(first, second).alias("month_first"), made(second, first).alias("day_first"))

    # The numbers are split once, though both readings use them.
    return F.when(text.rlike(_SHAPE), F.get(F.transform(F.array(n), read), F.lit(0)))


def _separator(text: Column) -> Column:
    return F.regexp_extract(text, r"^\d{1,2}([/.-])", 1)


def learn_formats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for each column an array with the combined mask of each separator (null where the shape does not occur).

    A text that no format reads, such as 31/31/2021, says nothing about the others.
    """
    # Text, reading and mask are columns of their own, as each is used several times.
    ids = range(len(columns))
    texts = df.select(*[clean_text(F.col(f"`{c}`")).alias(f"t{i}") for i, c in enumerate(columns)])
    read = texts.select("*", *[_readings(F.col(f"t{i}")).alias(f"r{i}") for i in ids])

    def mask(r: Column) -> Column:
        return r["month_first"].isNotNull().cast("int") * MONTH_FIRST + r["day_first"].isNotNull().cast("int") * DAY_FIRST

    masks = read.select(*[x for i in ids for x in (mask(F.col(f"r{i}")).alias(f"m{i}"), _separator(F.col(f"t{i}")).alias(f"s{i}"))])
    return masks.agg(
        *[
            F.array(*[F.bit_and(F.when((F.col(f"m{i}") > 0) & (F.col(f"s{i}") == s), F.col(f"m{i}"))) for s in SEPARATORS]).alias(c)
            for i, c in enumerate(columns)
        ]
    )


def _read_by(text: Column, read: Column, masks: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(s) for s in SEPARATORS]), _separator(text)).cast("int")
    mask = F.get(masks, place - 1)
    day_first = mask.bitwiseAND(MONTH_FIRST + DAY_FIRST) == DAY_FIRST
    both = F.when(day_first, F.coalesce(read["day_first"], read["month_first"])).otherwise(F.coalesce(read["month_first"], read["day_first"]))
    return F.when(text.rlike(_SHAPE), both).otherwise(parse_timestamp(text, LENIENT_FORMATS))


def read_learned(c: Column, masks: Column) -> Column:
    """A text column as timestamps by the learned masks; texts of other shapes by the fixed list."""
    text = clean_text(c)
    return _read_by(text, _readings(text), masks)


def with_learned_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with text columns read as timestamps, each by the formats of its whole column."""
    facts = learn_formats(df, columns).select(F.struct(*columns).alias("f")).scalar()
    texts = df.withColumns({c: clean_text(F.col(f"`{c}`")) for c in columns})
    read = texts.withColumns({f"_read{i}": _readings(F.col(f"`{c}`")) for i, c in enumerate(columns)})
    out = {c: _read_by(F.col(f"`{c}`"), F.col(f"_read{i}"), facts.getField(c)) for i, c in enumerate(columns)}
    return read.withColumns(out).drop(*[f"_read{i}" for i in range(len(columns))])
