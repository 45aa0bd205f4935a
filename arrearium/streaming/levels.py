"""Streams whose results stay small to read: levelled folders, bounded look-ups of seen ids, and totals kept by changes.

Each micro-batch is stored as a folder and named by a manifest.  When ``fan`` folders of one level stand together they
are folded into one of the next level, by the stream itself, so a table of N batches has at most ``fan`` folders for each
of log N levels.  Readers follow one manifest: they see a batch in its own folder or in a merged one, never in both and
never half.  A batch that the stream repeats after a failure is known by its number and not stored again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from arrearium.operators.fold import flat_states, fold_states
from arrearium.operators.manifests import Manifests
from arrearium.session import scratch_path

#: Folders of one level that are merged, and manifests that readers may still hold.
FAN, KEEP = 4, 8
#: Buckets of ids, bits of marks for each id, and bits of one mark.
BUCKETS, BITS_PER_ID, MARK_BITS = 64, 32, 32_768


@dataclass(frozen=True)
class Segment:
    """A folder with the rows of the batches ``first`` to ``last``."""

    first: int
    last: int
    level: int
    folder: str


class LevelTable:
    """Rows of micro-batches in levelled folders.

    ``fold`` turns the rows of several batches into fewer rows of the same columns, in any order and grouping of batches.
    """

    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], fan: int = FAN, keep: int = KEEP):
        self.spark, self.path, self.fold, self.fan, self.keep = spark, path.rstrip("/"), fold, fan, keep
        self.manifests = Manifests(spark, f"{self.path}/manifests")

    def _now(self) -> tuple[int, list[Segment], str | None]:
        number = max(self.manifests.numbers(), default=0)
        if not number:
            return 0, [], None
        said = self.manifests.read(number)
        return number, [Segment(**s) for s in said["segments"]], said["schema"]

    def segments(self) -> list[Segment]:
        return self._now()[1]

    def holds(self, batch: int) -> bool:
        return any(s.first <= batch <= s.last for s in self.segments())

    def _store(self, rows: DataFrame, folder: str) -> None:
        rows.write.parquet(f"{self.path}/{folder}/rows")

    def _rows(self, segments: Sequence[Segment], schema: str) -> DataFrame:
        return self._read([f"{s.folder}/rows" for s in segments], schema)

    def _read(self, folders: Sequence[str], schema: str | StructType) -> DataFrame:
        # Folders inside are looked up as they are, not as partitions of one table.
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", True)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Store a batch and merge full levels; false if the batch is stored already."""
        number, segments, schema = self._now()
        if any(s.first <= batch <= s.last for s in segments):
            return False
        rows = self.fold(rows)
        schema = schema or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        new = Segment(batch, batch, 0, f"data/{batch}-{uuid.uuid4().hex[:12]}")
        self._store(rows, new.folder)
        segments = [*segments, new]
        self._commit(number + 1, segments, schema)
        while len(segments) >= self.fan and len({s.level for s in segments[-self.fan :]}) == 1:
            part = segments[-self.fan :]
            merged = Segment(part[0].first, part[-1].last, part[0].level + 1, f"data/{part[0].first}-{part[-1].last}-{uuid.uuid4().hex[:12]}")
            self._store(self.fold(self._rows(part, schema)), merged.folder)
            segments = [*segments[: -self.fan], merged]
            number += 1
            self._commit(number + 1, segments, schema)
        self._expire()
        return True

    def _commit(self, number: int, segments: Sequence[Segment], schema: str) -> None:
        self.manifests.commit(number, {"segments": [asdict(s) for s in segments], "schema": schema})

    def _expire(self) -> None:
        """Manifests before the last ``keep`` go, and the folders that only they name."""
        numbers = self.manifests.numbers()
        old, kept = numbers[: -self.keep], numbers[-self.keep :]
        if not old:
            return
        named = {s["folder"] for n in kept for s in self.manifests.read(n)["segments"]}
        gone = {s["folder"] for n in old for s in self.manifests.read(n)["segments"]} - named
        for n in old:
            self.manifests.drop(n)
        for folder in gone:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def read(self) -> DataFrame:
        """All rows, folded."""
        _, segments, schema = self._now()
        if schema is None:
            raise FileNotFoundError(f"nothing is stored in {self.path}")
        return self.fold(self._rows(segments, schema))


# ---- upserts ---------------------------------------------------------------------


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    at = F.struct(*order)
    return df.withColumn("_first_at", at).withColumn("_last_at", at)


def upsert_table(
    spark: SparkSession, path: str, keys: Sequence[str], sticky: Sequence[str], mutable: Sequence[str], fan: int = FAN
) -> LevelTable:
    """A table that keeps ``sticky`` columns as first seen and ``mutable`` ones as last seen."""
    return LevelTable(spark, path, lambda df: flat_states(fold_states(df, keys, sticky, mutable), keys, sticky, mutable), fan)


def start_upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], sticky: Sequence[str], mutable: Sequence[str],
    order: Sequence[str], fan: int = FAN,
) -> StreamingQuery:
    """Upsert everything that is available now, then stop; read it by ``upsert_table(...).read()``."""

    def write(df: DataFrame, batch: int) -> None:
        upsert_table(df.sparkSession, path, keys, sticky, mutable, fan).append(_placed(df, order), batch)

    return _started(stream, checkpoint, write)


def _started(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---- seen ids --------------------------------------------------------------------


class SeenItems(LevelTable):
    """The first version of every id, in buckets of the id, with marks that say which buckets may hold an id.

    Marks are Bloom filters: each id sets two of ``BITS_PER_ID`` bits for each id in its segment and bucket.  A look-up
    reads the marks of the asked ids' places and only the buckets of segments in which some id has both bits set.
    """

    def __init__(self, spark: SparkSession, path: str, ids: Sequence[str], columns: Sequence[str], fan: int = FAN):
        super().__init__(spark, path, lambda df: flat_states(fold_states(df, ids, columns, []), ids, columns, []), fan)
        self.ids = list(ids)
        #: Buckets that look-ups have read, and all that there were.
        self.looked, self.present = 0, 0

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.ids), F.lit(BUCKETS)).cast("int")

    def _places(self, bits: Column) -> Column:
        hashes = [F.pmod(F.xxhash64(F.lit(seed), *self.ids), bits) for seed in (1, 2)]
        return F.array(*[F.struct(F.floor(h / MARK_BITS).alias("part"), (h % MARK_BITS).alias("place")) for h in hashes])

    def _store(self, rows: DataFrame, folder: str) -> None:
        path = f"{self.path}/{folder}"
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
        stored = self._read([f"{folder}/rows"], rows.schema)
        parts = max(1, -(-stored.count() * BITS_PER_ID // (MARK_BITS * BUCKETS)))
        marks = stored.select(self._bucket().alias("bucket"), F.inline(self._places(F.lit(parts * MARK_BITS))))
        marks.groupBy("bucket", "part").agg(F.bitmap_construct_agg("place").alias("bits")).select(
            "*", F.lit(folder).alias("folder"), F.lit(parts).alias("parts")
        ).write.parquet(f"{path}/marks")

    def lookup(self, asked: DataFrame) -> DataFrame | None:
        """Stored states of the asked ids; None if no bucket can hold one.  ``asked`` is read twice, so it should be stored."""
        _, segments, schema = self._now()
        if not segments:
            return None
        marks = self.spark.read.parquet(*[f"{self.path}/{s.folder}/marks" for s in segments])
        sizes = marks.groupBy("folder", "bucket").agg(F.max("parts").alias("parts"))
        wanted = asked.select(*self.ids, self._bucket().alias("bucket")).join(sizes, "bucket").select(
            "folder", "bucket", F.xxhash64(*self.ids).alias("id"), F.inline(self._places(F.col("parts") * MARK_BITS))
        )
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.getbit(byte, (F.col("place") % 8).cast("int")) == 1
        hits = wanted.join(marks.drop("parts"), ["folder", "bucket", "part"]).where(is_set)
        may = hits.groupBy("folder", "bucket", "id").agg(F.count("*").alias("n"))
        # To the driver come names of buckets: at most BUCKETS for each of the few segments.
        both = may.where("n >= 2").select("folder", "bucket").distinct().collect()
        self.looked += len(both)
        self.present += sizes.count()
        if not both:
            return None
        found = self._read([f"{r['folder']}/rows/bucket={r['bucket']}" for r in both], schema)
        return self.fold(found.join(asked.select(*self.ids), self.ids, "left_semi"))


def seen_items(spark: SparkSession, path: str, ids: Sequence[str], columns: Sequence[str], fan: int = FAN) -> SeenItems:
    return SeenItems(spark, path, ids, columns, fan)


def start_distinct(
    stream: DataFrame, path: str, checkpoint: str, ids: Sequence[str], order: Sequence[str],
    looked: Callable[[int, int], None] | None = None, fan: int = FAN,
) -> StreamingQuery:
    """Keep the first version of every id by ``order``, storing of each batch only what is new, then stop.

    An id never seen before counts however old it is; a copy is stored only if it is earlier than the stored one.
    ``looked`` is told after each batch how many buckets were read and how many there were.
    """
    columns = [c for c in stream.columns if c not in ids]

    def write(df: DataFrame, batch: int) -> None:
        items = seen_items(df.sparkSession, path, ids, columns, fan)
        if items.holds(batch):
            return
        with _Stored(items.fold(_placed(df, order)), "batch") as fresh:
            items.append(_changes(items, fresh, ids).select(*[F.col(f"new.{c}") for c in fresh.columns]), batch)
        if looked:
            looked(items.looked, items.present)

    return _started(stream, checkpoint, write)


class _Stored:
    """A table stored while it is worked on."""

    def __init__(self, df: DataFrame, name: str):
        self.df, self.path = df, scratch_path(df.sparkSession, name)

    def __enter__(self) -> DataFrame:
        self.df.write.parquet(self.path)
        return self.df.sparkSession.read.schema(self.df.schema).parquet(self.path)

    def __exit__(self, *_) -> None:
        spark = self.df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _changes(items: SeenItems, fresh: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(new, old) of the fresh rows that are new (old is null) or earlier than what is stored."""
    known = items.lookup(fresh)
    new = fresh.select(*[F.col(c).alias(f"_i{k}") for k, c in enumerate(ids)], F.struct(*fresh.columns).alias("new"))
    if known is None:
        return new.select("new", F.lit(None).cast(new.schema["new"].dataType).alias("old"))
    old = known.select(*[F.col(c).alias(f"_o{k}") for k, c in enumerate(ids)], F.struct(*fresh.columns).alias("old"))
    same = [F.col(f"_i{k}").eqNullSafe(F.col(f"_o{k}")) for k in range(len(ids))]
    both = new.join(old, F.expr("true") if not same else _all(same), "left")
    return both.where(F.col("old").isNull() | (F.col("new._first_at") < F.col("old._first_at"))).select("new", "old")


def _all(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


# ---- totals by changes -----------------------------------------------------------


def _totals_fold(by: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    def fold(df: DataFrame) -> DataFrame:
        kind = df.schema["total"].dataType
        return df.groupBy("day", *by).agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total"))

    return fold


def totals_table(spark: SparkSession, path: str, by: Sequence[str], fan: int = FAN) -> LevelTable:
    """Signed changes of the totals; reading it reads no items."""
    return LevelTable(spark, f"{path}/changes", _totals_fold(by), fan)


def totals(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """Count and sum per day and ``by`` columns of distinct items."""
    return totals_table(spark, path, by).read().where("n <> 0")


def start_totals(
    stream: DataFrame, path: str, checkpoint: str, ids: Sequence[str], order: Sequence[str], on: str, amount: str,
    by: Sequence[str], fan: int = FAN,
) -> StreamingQuery:
    """Keep count and sum per day and ``by`` columns of the first version of every id, then stop.

    A batch stores what it changes: a new id adds its row, and a version that turns out earlier than the stored one adds
    its own and takes the stored one back.  The changes are stored before the ids, so a batch that fails in between is
    finished when the stream repeats it and counted once.
    """
    columns = [c for c in stream.columns if c not in ids]

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        items, changes = seen_items(spark, f"{path}/items", ids, columns, fan), totals_table(spark, path, by, fan)
        with _Stored(items.fold(_placed(df, order)), "batch") as fresh:
            if not changes.holds(batch):
                changed = _changes(items, fresh, ids)
                both = F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))
                rows = changed.select(F.inline(both)).where(F.col("row").isNotNull()).select("sign", "row.*")
                changes.append(
                    rows.select(
                        F.col(on).cast("date").alias("day"), *by, F.col("sign").cast("long").alias("n"),
                        (F.col("sign") * F.col(amount)).cast(_wide(df, amount)).alias("total"),
                    ),
                    batch,
                )
            items.append(fresh, batch)

    return _started(stream, checkpoint, write)


def _wide(df: DataFrame, amount: str) -> str:
    kind = df.schema[amount].dataType
    if kind.typeName() == "decimal":
        return f"decimal(38,{kind.scale})"
    return "double" if kind.typeName() in ("float", "double") else "long"
