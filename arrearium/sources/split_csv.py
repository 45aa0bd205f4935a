"""CSV exports read by many tasks though their cells hold line breaks.

A file is read line by line in splits.  A line break ends a record if the quotes before it are even in number, so the
only thing a split does not know is whether it begins inside a cell.  The parities of splits are a monoid: every split
counts its quotes in one pass, and a running sum over the splits of a file gives the state in which each begins.  Splits
whose lines are all records of their own go on as they are; only the lines of the others are numbered in order and put
together, a piece that continues an earlier split by the place where its record began.  Spark's own ``from_csv`` parses
the records.

A quote that neither opens nor closes a cell nor is doubled would upset the count.  Exports with such quotes are found in
the first pass and read whole; a record that is no CSV after cutting stops the job.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrearium.session import scratch_path

#: A quote with neither an end of a cell nor another quote beside it, which CSV does not have.
_STRAY = r'[^,"]"[^,"\r]'
#: A quoted cell between two separators.
_QUOTED_CELL = r'(?<![^,])"[^"]*"(?![^,])'
_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}


@dataclass(frozen=True)
class Splits:
    """The splits of an export: the stored state of each, its headers, and what it needs."""

    table: DataFrame
    headers: list[str]
    broken: int
    whole: int
    stray: bool


def pin_splits(spark: SparkSession) -> None:
    """Two passes must cut files at the same places, whatever the number of executors is by then."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))


def splits_of(lines: DataFrame) -> Splits:
    """The first pass over (file_path, block_start, line, value).

    One row per split: whether it begins inside a cell, where an open record began, and whether all its lines are
    records.  To the driver come the distinct headers and three counts.
    """
    value, line = F.col("value"), F.col("line")
    quoted = value.contains('"')
    odd = F.when(quoted, _quotes(value) % 2).otherwise(0) == 1
    found = lines.groupBy("file_path", "block_start").agg(
        (F.count_if(odd) % 2).alias("parity"),
        F.max(F.when(odd, line)).alias("last_odd"),
        F.max(quoted & value.rlike(_STRAY)).alias("stray"),
        F.min(line).alias("first"),
        F.min_by("value", "line").alias("header"),
    )
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2
    state = found.withColumn("inside", inside).withColumn(
        # A split that ends inside a cell opened its record on its last line with odd quotes, if it has any.
        "opened", F.when(((F.col("inside") + F.col("parity")) % 2 == 1) & F.col("last_odd").isNotNull(), F.struct("block_start", "last_odd")),
    )
    header = F.first("header").over(Window.partitionBy("file_path").orderBy("block_start"))
    table = state.select(
        F.xxhash64("file_path").alias("file_key"), "block_start", (F.col("inside") == 1).alias("inside"),
        ((F.col("inside") == 1) | F.col("last_odd").isNotNull()).alias("broken"), "stray",
        F.last("opened", ignorenulls=True).over(before).alias("opened"),
        F.when(F.col("block_start") == 0, F.col("first")).alias("header_line"),
        _plain(header).alias("header"), F.regexp_replace("file_path", "[^/]*$", "").alias("folder"),
    )
    path = scratch_path(lines.sparkSession, "splits")
    table.write.parquet(path)
    stored = lines.sparkSession.read.parquet(path)
    seen = stored.groupBy("folder", "header").agg(
        F.count_if("broken").alias("broken"), F.count_if(~F.col("broken")).alias("whole"), F.max("stray").alias("stray")
    )
    mixed = seen.groupBy("folder").agg(F.count("*").alias("n")).where("n > 1").select("folder").first()
    if mixed:
        raise ValueError(f"files with different headers in {mixed['folder']}")
    kinds = seen.groupBy("header").agg(F.sum("broken").alias("b"), F.sum("whole").alias("w"), F.max("stray").alias("s")).collect()
    headers = sorted(k["header"] for k in kinds)
    if any(h.count('"') % 2 for h in headers):
        raise ValueError("a header with a line break")
    return Splits(stored.drop("folder"), headers, sum(k["b"] for k in kinds), sum(k["w"] for k in kinds), any(k["s"] for k in kinds))


def _quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def _plain(text: Column) -> Column:
    """Without the return of a line that ends in CR LF, and without a byte order mark."""
    text = F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)
    return F.when(text.startswith("﻿"), F.substr(text, F.lit(2))).otherwise(text)


def records(lines: DataFrame, splits: Splits) -> DataFrame:
    """The second pass: one row per record, ``value`` its text, placed where it begins; headers and empty lines are left out."""
    table = splits.table.withColumnsRenamed({"file_key": "split_file", "block_start": "split_start"}).drop("stray")
    here = (F.xxhash64("file_path") == F.col("split_file")) & (F.col("block_start") == F.col("split_start"))
    known = lines.join(table, here).drop("split_file", "split_start")
    rest = [c for c in lines.columns if c not in ("file_path", "block_start", "line", "value")]
    body = ["file_path", "block_start", "line", "value", "header", *rest]
    parts = []
    if splits.whole or not splits.broken:
        parts.append(known.where(~F.col("broken") & ~F.col("line").eqNullSafe(F.col("header_line"))).select(body))
    if splits.broken:
        parts.append(_joined(known.where("broken"), rest).select(body))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.withColumn("value", _plain(F.col("value"))).where(F.col("value") != "")


def _joined(lines: DataFrame, rest: Sequence[str]) -> DataFrame:
    """The lines of broken splits put together: numbered within their split, so a long file is many groups."""
    order = Window.partitionBy("file_path", "block_start").orderBy("line")
    odd = F.col("value").contains('"') & (_quotes(F.col("value")) % 2 == 1)
    earlier = F.count_if(odd).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = (earlier + F.col("inside").cast("int")) % 2 == 0
    began = F.last(F.when(F.col("starts"), F.col("line")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = lines.withColumn("starts", starts).withColumn("began", began).select(
        "file_path", "header", *rest, "header_line",
        F.when(F.col("began").isNotNull(), F.col("block_start")).otherwise(F.col("opened.block_start")).alias("at"),
        F.coalesce("began", "opened.last_odd").alias("began"), F.struct("block_start", "line", "value").alias("piece"),
    )
    whole = placed.groupBy("file_path", "at", "began").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["value"]), "\n").alias("value"),
        F.max("header_line").alias("header_line"), F.first("header").alias("header"), *[F.first(c).alias(c) for c in rest],
    )
    return whole.where(~F.col("began").eqNullSafe(F.col("header_line"))).withColumnsRenamed({"at": "block_start", "began": "line"})


def names_of(header: str) -> list[str]:
    """Column names of a header line: empty ones by their place, repeated ones with it."""
    names = next(csv.reader([header]), [])
    return [f"_c{i}" if n == "" else f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names)]


def cells(rows: DataFrame, headers: Sequence[str], columns: Sequence[str] | None, finish: Callable[[Column], Column]) -> list[Column]:
    """Named cells of records by each record's own header; a header without the column gives null.

    ``rows`` has the parsed record as ``cells``, an array, and its header.
    """
    known = {h: names_of(h) for h in headers}
    wanted = list(columns) if columns is not None else list(dict.fromkeys(n for names in known.values() for n in names))
    out = []
    for name in wanted:
        places = [(h, names.index(name)) for h, names in known.items() if name in names]
        if not places:
            continue
        cell: Column | None = None
        for h, i in places:
            one = F.get(F.col("cells"), F.lit(i))
            if len(known) > 1:
                hit = F.col("header") == F.lit(h)
                cell = F.when(hit, one) if cell is None else cell.when(hit, one)
            else:
                cell = one
        out.append(finish(cell).alias(name))
    return out


def parsed(rows: DataFrame, headers: Sequence[str]) -> DataFrame:
    """``value`` of each record as an array of cells in ``cells``; text that is no CSV stops the job."""
    width = max((len(names_of(h)) for h in headers), default=1)
    value = F.col("value")
    left = F.regexp_replace(F.replace(value, F.lit('""'), F.lit("")), _QUOTED_CELL, "")
    said = F.concat(F.lit("a quote that is neither doubled nor around a cell in "), F.col("file_path"), F.lit(": "), F.left(value, F.lit(80)))
    checked = F.when(value.contains('"') & left.contains('"'), F.raise_error(said)).otherwise(value)
    schema = ", ".join(f"c{i} string" for i in range(width))
    # Generated, not projected: a record is parsed once, however many filters on its cells are pushed down.
    row = F.inline(F.array(F.from_csv(checked, schema, _OPTIONS)))
    kept = [c for c in rows.columns if c != "value"]
    names = [f"_cell{i}" for i in range(width)]
    return rows.select(*kept, row.alias(*names)).select(*kept, F.array(*names).alias("cells"))
