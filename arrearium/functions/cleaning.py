"""Text, number, date and label cleaning as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrearium import values

# Every character Unicode calls white space, not just the blank that SQL trim drops.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column, tokens: Sequence[str] = values.NULL_TOKENS) -> Column:
    """Trimmed text; the tokens that stand for "no value" become null."""
    text = strip(c)
    return F.when(~F.lower(text).isin(*tokens), text)


def clean_number(c: Column, drop: str = ", ", to: str = "decimal(18,2)") -> Column:
    """Number text without the ``drop`` characters; anything unreadable is null."""
    return strip(F.translate(c, drop, "")).try_cast(to)


def clean_int(c: Column, drop: str = ", ") -> Column:
    """Integer part of a number text."""
    return clean_number(c, drop, "decimal(28,6)").try_cast("int")


Format = tuple[str, str | None]


def parse_timestamp(c: Column, formats: Sequence[Format]) -> Column:
    """First format that reads the text wins; null when none does.

    The shape test comes first because a failed parse costs an exception per row.
    """
    tries = []
    for shape, pattern in formats:
        read = c.try_cast("timestamp") if pattern is None else F.try_to_timestamp(c, F.lit(pattern))
        tries.append(F.when(c.rlike(shape), read))
    return F.coalesce(*tries)


def clean_timestamp(c: Column, formats: Sequence[Format] = values.LENIENT_FORMATS) -> Column:
    return parse_timestamp(clean_text(c), formats)


def clean_date(c: Column, tokens: Sequence[str] = values.NULL_TOKENS) -> Column:
    return parse_timestamp(clean_text(c, tokens), values.LENIENT_FORMATS).cast("date")


def full_name(*parts: Column) -> Column:
    """Non-blank parts joined by a blank; null when all are blank."""
    kept = [F.when(strip(p) != "", p) for p in parts]
    return F.nullif(F.concat_ws(" ", *kept), F.lit(""))


def is_test_name(*parts: Column) -> Column:
    """True when any part contains "test" in any case (null parts do not)."""
    hit = F.lit(False)
    for p in parts:
        hit = hit | F.lower(F.coalesce(p, F.lit(""))).contains("test")
    return hit


def has_text(c: Column) -> Column:
    """A usable key: not null and not blank."""
    return c.isNotNull() & (F.trim(c) != "")


def _spelling(c: Column, table: Mapping[str, Sequence[str]]) -> Column | None:
    out = None
    for label, spellings in table.items():
        hit = c.isin(*spellings)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def normal_status(raw: Column, paid_off: Column | None = None) -> Column:
    """One spelling per status; ``paid_off`` (when true) overrides the raw status."""
    text = F.upper(F.trim(raw))
    status = _spelling(text, values.STATUS_SPELLINGS).otherwise(text)
    if paid_off is None:
        return status
    return F.when(paid_off, "PAID_OFF").otherwise(status)


def normal_flag(raw: Column) -> Column:
    """'true' or 'false' as text; null counts as 'false'."""
    return F.when(F.lower(F.trim(raw)).isin(*values.TRUE_SPELLINGS), "true").otherwise("false")


def normal_deal(raw: Column) -> Column:
    """PAYG or FULL; anything unknown is PAYG."""
    return _spelling(F.upper(F.trim(raw)), values.DEAL_SPELLINGS).otherwise("PAYG")


def lookup_deal(raw: Column) -> Column:
    """PAYG or FULL; anything else is kept as cleaned text (product lookup rule)."""
    return _spelling(F.upper(raw), values.DEAL_SPELLINGS).otherwise(clean_text(raw))
