"""Raw landing zone: ``{root}/{source}/{entity}/ingest_date=YYYY-MM-DD/landing=N/`` files.

A day may be landed again: the next landing number makes the newer items override the older ones.  What cannot be
read stops the job or goes to a table of rejects; nothing vanishes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium import values
from arrearium.sources import split_csv

#: Items that a landed file holds at most.
FILE_ITEMS = 100_000
ITEM_ORDER = ("ingest_date", "landing", "page", "file_path", "block_start", "position")


def entity_path(root: str, source: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{source}/{entity}"


# ---- landing -------------------------------------------------------------------


def land_items(df: DataFrame, path: str, landing: int = 0) -> None:
    """Write rows as JSON, one object per line, under their ``ingest_date`` folders.

    A narrow write: nothing is shuffled.  Files are compressed; a compressed file is read by one task, so none holds more
    than ``FILE_ITEMS`` items.  Rows of many dates should be rebalanced by date first, so that every task writes few
    folders.  ``landing`` numbers the landings of a day (``next_landing``); a repeated landing of the same number adds to it.
    """
    numbered = df.withColumn("landing", F.lit(landing))
    (
        numbered.write.mode("append").partitionBy("ingest_date", "landing")
        .option("compression", "gzip").option("maxRecordsPerFile", FILE_ITEMS).json(path)
    )


def land_csv(df: DataFrame, path: str, landing: int = 0, compressed: bool = False) -> None:
    """Write an export as header CSV under its ``ingest_date`` folders; quotes are doubled.

    Plain files are read in splits.  A ``compressed`` one is read by one task, so none holds more than ``FILE_ITEMS`` records.
    """
    out = df.withColumn("landing", F.lit(landing)).write.mode("append").partitionBy("ingest_date", "landing")
    if compressed:
        out = out.option("compression", "gzip").option("maxRecordsPerFile", FILE_ITEMS)
    out.option("header", True).option("escape", '"').csv(path)


def next_landing(spark: SparkSession, path: str, ingest_date: str) -> int:
    """The number after the day's last landing, from the names of its folders."""
    numbers = [int(f.removeprefix("landing=")) for f in folders(spark, f"{path}/ingest_date={ingest_date}")]
    return max(numbers, default=-1) + 1


def landings(spark: SparkSession, path: str) -> dict[str, int]:
    """Every landing of an entity and its bytes, by its folder below ``path``; no file is read."""
    out = {}
    for day in folders(spark, path):
        for name in folders(spark, f"{path}/{day}") or [""]:
            place = f"{day}/{name}".rstrip("/")
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{place}")
            out[place] = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    return out


# ---- file choice ---------------------------------------------------------------


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, modified, length (and folder columns) of every file; no content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", False)
        .option("pathGlobFilter", pattern)
        .load(path)
        .drop("content")
    )
    return files.select(
        "*", F.element_at(F.split("path", "/"), -1).alias("name")
    ).withColumnRenamed("modificationTime", "modified")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``name=value`` folders directly below a path; no file is listed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if "=" in s.getPath().getName())


def latest_date(spark: SparkSession, path: str) -> str | None:
    """Newest ingest date of an entity, from the names of its date folders."""
    dates = [f.removeprefix("ingest_date=") for f in folders(spark, path) if f.startswith("ingest_date=")]
    return max(dates, default=None)


def preferred_file(files: DataFrame, preferred: str | None = None) -> DataFrame:
    """One row: the newest file whose name contains ``preferred``, else the newest file."""
    fits = F.col("name").contains(preferred) if preferred else F.lit(True)
    return files.groupBy().agg(
        F.max_by(F.struct(*files.columns), F.struct(fits, "modified", "path")).alias("_f")
    ).select("_f.*")


def preferred_export(files: DataFrame, preferred: str | None = None) -> DataFrame:
    """One row (folder, modified): the newest export folder whose name contains ``preferred``, else the newest one.

    An export is a folder of as many files as its writer's tasks made; it is as new as its newest file.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    exports = files.groupBy(folder.alias("folder")).agg(F.max("modified").alias("modified"))
    name = F.element_at(F.split("folder", "/"), -1)
    return preferred_file(exports.select("*", name.alias("name"), F.col("folder").alias("path")), preferred).select("folder", "modified")


def on_date(df: DataFrame, ingest_date: str) -> DataFrame:
    """One ingest date; prunes folders."""
    return df.filter(F.col("ingest_date") == F.lit(ingest_date).cast("date"))


# ---- readers -------------------------------------------------------------------


def _place() -> list[Column]:
    """Columns that order rows as the files were written.

    The page number is compared as a number (page 1000 comes after page 999).  What still holds a folder is none, and
    is not tried: a failed cast costs an exception per row.
    """
    path = F.col("_metadata.file_path")
    page = F.substring_index(F.substring_index(path, "page_", -1), ".", 1)
    return [
        F.when(~page.contains("/"), page.try_cast("int")).alias("page"),
        path.alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line"),
    ]


def _landed(df: DataFrame, ingest_date: str | None) -> DataFrame:
    """The lines with ``ingest_date`` as a date and ``landing`` (null and 0 outside such folders).

    The date filter sits directly on the scan: above the row numbering it could not
    prune folders.
    """
    if "landing" not in df.columns:
        df = df.withColumn("landing", F.lit(0))
    if "ingest_date" not in df.columns:
        return df.withColumn("ingest_date", F.lit(None).cast("date"))
    dated = df if ingest_date is None else on_date(df, ingest_date)
    return dated.withColumn("ingest_date", F.col("ingest_date").cast("date"))


#: What JSON has and what some parsers let pass besides: quotes are double.
_JSON = {"allowSingleQuotes": "false"}


def once(value: Column) -> Column:
    """``value`` as a generated column: computed once a row, however often filters and columns above refer to it.

    Spark copies a plain column's expression into every filter that it pushes below it.
    """
    return F.explode(F.array(value))


def each_once(columns: Sequence[Column]) -> Column:
    """Named columns as generated ones, as ``once``."""
    return F.inline(F.array(F.struct(*columns)))


def _with_judged(lines: DataFrame) -> DataFrame:
    """``lines`` with ``_bad``: text that is not one object or one array, such as a page that was cut off or two objects
    in a row.

    A name may be repeated in an object: its last value counts.
    """
    value = F.col("value")
    starts = F.ltrim(value).startswith("[") | F.ltrim(value).startswith("{")
    # Between brackets, so that an object is judged as a list's element is, and nothing may follow it.
    alone = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>", _JSON)
    return lines.select("*", once(~starts | (F.coalesce(F.size(alone), F.lit(0)) != 1)).alias("_bad"))


def _elements(value: Column) -> Column:
    """The elements of a readable line as texts."""
    is_page = F.ltrim(value).startswith("[")
    return F.when(is_page, F.from_json(value, "array<string>", _JSON)).otherwise(F.array(value))


def _is_object(element: Column) -> Column:
    return F.coalesce(F.ltrim(element).startswith("{"), F.lit(False))


def _texts(spark: SparkSession, path: str, only: Sequence[str] | None, **options) -> DataFrame:
    """Lines of all landings, or of those whose folders are given."""
    if only is None:
        return spark.read.text(path, **options)
    return spark.read.option("basePath", path).text([f"{path}/{place}" for place in only], **options)


def _lines(
    spark: SparkSession, path: str, whole_files: bool, ingest_date: str | None, only: Sequence[str] | None = None
) -> DataFrame:
    """Landed lines that hold something."""
    return _landed(_texts(spark, path, only, wholetext=whole_files), ingest_date).where(F.trim("value") != "")


def read_items(
    spark: SparkSession,
    path: str,
    whole_files: bool = False,
    ingest_date: str | None = None,
    skip_unreadable: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Raw items as JSON text in ``raw``, one row per item.

    A line is one object or one page (an array of objects).  ``whole_files=True`` reads
    files that hold one pretty-printed page each.  Adds the columns of ``ITEM_ORDER``:
    a total order in which later items override earlier ones.  With ``ingest_date`` only
    that day's folder is read, with ``only`` the landings of these folders.

    A line that cannot be read, or an element of a page that is null or no object, fails the job.  With
    ``skip_unreadable`` the readable items are handed out; ``read_rejects`` hands out the others.
    """
    lines = _lines(spark, path, whole_files, ingest_date, only)
    lines = _with_judged(lines.select("ingest_date", "landing", "value", *_place()))
    where = F.concat(F.lit("unreadable item in "), F.col("file_path"), F.lit(": "))
    if skip_unreadable:
        lines = lines.where(~F.col("_bad"))
        items = F.filter(_elements(F.col("value")), _is_object)
    else:
        said = F.concat(where, F.left("value", F.lit(80)))
        value = F.when(F.col("_bad"), F.raise_error(said)).otherwise(F.col("value"))
        items = F.transform(
            _elements(value),
            lambda x: F.when(_is_object(x), x).otherwise(F.raise_error(F.concat(where, F.left(F.coalesce(x, F.lit("null")), F.lit(80))))),
        )
    return (
        lines.select("ingest_date", "landing", "page", "file_path", "block_start", "line", F.posexplode(items).alias("_pos", "raw"))
        .withColumn("position", F.struct("line", "_pos"))
        .select(*ITEM_ORDER, "raw")
    )


def read_rejects(
    spark: SparkSession, path: str, whole_files: bool = False, ingest_date: str | None = None
) -> DataFrame:
    """The lines, and the elements of readable lines, that ``read_items`` cannot read, with their place."""
    lines = _with_judged(_lines(spark, path, whole_files, ingest_date).select("ingest_date", "landing", "value", *_place()[:3]))
    odd = F.transform(F.filter(_elements(F.col("value")), lambda x: ~_is_object(x)), lambda x: F.coalesce(x, F.lit("null")))
    rejects = F.when(F.col("_bad"), F.array("value")).otherwise(odd)
    return lines.select("ingest_date", "landing", "page", "file_path", "block_start", F.explode(rejects).alias("raw"))


def read_pages(spark: SparkSession, path: str, schema: str, whole_files: bool = False) -> DataFrame:
    """Typed items straight from JSON pages, with only the fields of ``schema``."""
    return spark.read.schema(schema).option("multiLine", whole_files).json(path)


def _csv(spark: SparkSession):
    """A reader of header CSV whose quotes are doubled inside quoted cells.

    Cells may hold line breaks, so files are not split.  A file whose header differs from the columns asked for fails
    the job.
    """
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("enforceSchema", False)


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with every column as text; missing-value spellings become null."""
    df = _csv(spark).csv(path)
    wanted = df.columns if columns is None else [c for c in columns if c in df.columns]
    return df.select(*[_na_to_null(c) for c in wanted])


def _no_value(cell: Column) -> Column:
    return F.when(~cell.isin(*values.CSV_NA_TOKENS), cell)


def _na_to_null(name: str) -> Column:
    return _no_value(F.col(f"`{name}`")).alias(name)


def read_csv_export(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    ingest_date: str | None = None,
    whole_files: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """``read_csv_strings`` plus the file-order columns (page is null), each file read by as many tasks as its size asks for.

    Cells may hold line breaks.  Every landing is read under its own header, so columns may move, come and go from one
    to the next; files of one landing with different headers stop the job.  A first pass over all files finds headers
    and the states of the splits.  Exports with stray quotes, and all with ``whole_files``, are read a file per task.
    With ``only`` the landings of these folders are read.
    """
    split_csv.pin_splits(spark)
    lines = _landed(_texts(spark, path, only, lineSep="\n"), ingest_date).select("ingest_date", "landing", *_place(), "value")
    splits = None if whole_files else split_csv.splits_of(lines)
    if splits is None or splits.stray:
        return _whole_exports(spark, path, columns, ingest_date, only)
    rows = split_csv.parsed(split_csv.records(lines, splits), splits.headers)
    order = ["ingest_date", "landing", "page", "file_path", "block_start", F.col("line").alias("position")]
    return rows.select(*order, *split_csv.cells(rows, splits.headers, columns, _no_value))


def _whole_exports(
    spark: SparkSession, path: str, columns: Sequence[str] | None, ingest_date: str | None, only: Sequence[str] | None
) -> DataFrame:
    """Exports read a file per task: landings with one header share a scan."""
    days = [f"ingest_date={ingest_date}"] if ingest_date else folders(spark, path)
    places = [f"{path}/{d}/{n}".rstrip("/") for d in days for n in folders(spark, f"{path}/{d}") or [""]]
    places = places if only is None else [f"{path}/{place}" for place in only]
    reader = _csv(spark)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for place in places or [path]:
        by_header.setdefault(tuple(reader.csv(place).columns), []).append(place)
    out = None
    for header, paths in by_header.items():
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
        df = _landed(reader.schema(schema).option("basePath", path).csv(paths), ingest_date)
        wanted = [c for c in (columns or header) if c in header]
        part = df.select(
            "ingest_date", "landing", *_place(), *[_na_to_null(c) for c in wanted]
        ).withColumnRenamed("line", "position")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def project(df: DataFrame, mapping: Mapping[str, str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Keep and rename the mapped columns; a column the input lacks becomes a typed null."""
    types = types or {}
    out = []
    for source, target in mapping.items():
        kind = types.get(target, "string")
        c = F.col(f"`{source}`") if source in df.columns else F.lit(None).cast(kind)
        out.append(c.alias(target))
    return df.select(*out)


def with_raw(df: DataFrame, name: str = "raw_data") -> DataFrame:
    """Keep the whole row as JSON text beside the typed columns."""
    return df.withColumn(name, F.to_json(F.struct(*df.columns)))
