"""JSON field access, fallback chains and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(raw: Column, path: str) -> Column:
    """Text at a dotted path; numbers in the path are list positions.

    Key lookup is case-sensitive, unlike struct field access.  Of a repeated name the last value counts, except below
    list positions.
    """
    steps = path.split(".")
    if any(p.isdigit() for p in steps):
        return F.get_json_object(raw, "$" + "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in steps))
    schema = f"`{steps[-1]}` string"
    for p in reversed(steps[:-1]):
        schema = f"`{p}` struct<{schema.replace(' ', ': ', 1)}>"
    out = F.from_json(raw, schema)
    for p in steps:
        out = out.getField(p)
    return out


def first_path(raw: Column, *paths: str) -> Column:
    """First path whose value is neither missing, nor "", nor an empty list."""
    return first_value(*[json_text(raw, p) for p in paths])


def first_value(*cols: Column) -> Column:
    """First text that is neither null, nor "", nor an empty list; else null."""
    return F.coalesce(*[F.when(~c.isin("", "[]"), c) for c in cols])


def first_filled(*cols: Column) -> Column:
    """First non-empty text; the last candidate is taken as it is."""
    out = cols[-1]
    for c in reversed(cols[:-1]):
        out = F.when(c != "", c).otherwise(out)
    return out


def object_or_text(id_paths: Sequence[str], *fields: Column) -> Column:
    """An id from a field that is either an object or plain text.

    The first filled field counts (an empty object does not); an object yields its
    first filled ``id_paths``.
    """
    value = F.coalesce(*[F.when(~c.isin("", "[]", "{}"), c) for c in fields])
    is_object = value.startswith("{")
    return F.when(is_object, first_path(value, *id_paths)).otherwise(value)


def surrogate_key(*parts: Column) -> Column:
    """SHA-1 over the parts; a null part counts as empty text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha1(F.concat_ws("||", *texts))


def content_id(*parts: Column) -> Column:
    """Reproducible id for items without any id: SHA-256 of the parts' texts in the order given.

    Each text is preceded by its length and null is told from empty text, so no two
    different rows have one text.
    """
    texts = [p.cast("string") for p in parts]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)
