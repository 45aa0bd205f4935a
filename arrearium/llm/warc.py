"""WARC records in seekable Zstandard bundles.

Each task writes bundles: records are grouped into frames of about ``FRAME_BYTES`` that decompress on their own, and
a seek table in a skippable frame ends the file, so ordinary tools read the whole bundle and this reader any frame.
The manifest maps every record id to its bundle, frame and place in the frame.  Only the manifest rows of committed
tasks exist, so what a lost attempt has written is never referred to.

Equal payloads of at least ``least_bytes`` are stored once: the record with the largest id is the response, the
others are revisits that name it.

Records have the headers that WARC/1.1 demands.  A record's own id is a UUID made from the archive, the row's id and its
number, so rows that share an id have records of their own; the row's id stands in a header beside it.

Defined results: a null payload is empty; a null url gives no target; a null id is smaller than every other; of
rows that share payload and largest id one is the response; an empty table gives an empty manifest; other columns
are not archived.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import stored
from arrearium.session import scratch_path

FRAME_BYTES = 1_000_000
BUNDLE_BYTES = 512_000_000
LEAST_BYTES = 1000
#: Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Headers for the ids of rows, and the date of records whose rows have none.
ID, REFERS_ID, DATE = "X-Row-ID", "X-Refers-To-Row-ID", "1970-01-01T00:00:00Z"

MANIFEST = "record_id long, bundle string, frame_offset long, frame_bytes long, start long, length long"
RECORD = "record_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, target string"


def record_urn(archive: str, id: int | None, row: int) -> str:
    """The id of a row's record in an archive."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{id}/{row}').urn}>"


def record(
    id: int | None, url: str | None, payload: bytes | None, digest: str, refers_to: int | None, kind: str,
    urn: str = "", refers_urn: str = "", date: str = DATE,
) -> bytes:
    """One WARC record; a revisit has no payload."""
    body = payload or b"" if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {urn or record_urn('', id, 0)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html",
        f"Content-Length: {len(body)}",
        f"{ID}: {'' if id is None else id}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head.append(f"WARC-Refers-To: {refers_urn or record_urn('', refers_to, 0)}")
        head.append(f"{REFERS_ID}: {'' if refers_to is None else refers_to}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(start, headers, payload) of the records of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        yield at, head, data[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: compressed and whole size of each frame, and their number."""
    entries = b"".join(struct.pack("<II", *x) for x in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(file) -> list[tuple[int, int]]:
    """(offset, compressed size) of the frames of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(size - 9 - 8 * count)
    sizes = [packed for packed, _ in struct.iter_unpack("<II", file.read(8 * count))]
    at, out = 0, []
    for n in sizes:
        out.append((at, n))
        at += n
    return out


def _open(path: str):
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner


class _Bundle:
    """A bundle being written."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, inner = _open(self.path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out, self.at, self.frames = system.open_output_stream(inner, compression=None), 0, []
        self.waiting: list[tuple[int | None, bytes]] = []
        self.bytes = 0

    def add(self, id: int | None, data: bytes) -> list[tuple]:
        self.waiting.append((id, data))
        self.bytes += len(data)
        return self.flush() if self.bytes >= FRAME_BYTES else []

    def flush(self) -> list[tuple]:
        """End the frame; the manifest rows of its records."""
        if not self.waiting:
            return []
        whole = b"".join(data for _, data in self.waiting)
        packed = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(whole)
        self.out.write(packed)
        self.frames.append((len(packed), len(whole)))
        rows, start = [], 0
        for id, data in self.waiting:
            rows.append((id, self.path, self.at, len(packed), start, len(data)))
            start += len(data)
        self.at += len(packed)
        self.waiting, self.bytes = [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_MANIFEST = pa.schema(
    [("record_id", pa.int64()), ("bundle", pa.string())]
    + [(n, pa.int64()) for n in ("frame_offset", "frame_bytes", "start", "length")]
)
_RECORD = pa.schema(
    [("record_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("target", pa.string())]
)


def write(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = LEAST_BYTES, date: str = DATE,
) -> DataFrame:
    """Archive all rows below ``folder``; returns the manifest, stored.  ``date`` is when they were fetched.

    Rows are staged with a number each, so which of several equal rows is the response stays the same however often
    a task runs.  Copies are found by digest, counted on the map side first, so a hot payload is one row per task.
    """
    data = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    staged = stored(
        pages.select(
            F.col(id).cast("long").alias("id"),
            F.col(url).cast("string").alias("url"),
            data.alias("payload"),
            F.sha1(data).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "warc-pages",
    )
    # Stored, so that its size on disk decides whether it is sent to all; else hot payloads are split by the join.
    copies = stored(
        staged.where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("n"))
        .where("n > 1"),
        "warc-copies",
    )
    revisit = F.col("best").isNotNull() & (F.col("best")["row"] != F.col("row"))
    ready = staged.join(copies, staged["digest"] == copies["of"], "left").select(
        "id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest",
        F.when(revisit, F.col("best")["id"]).alias("refers_to"), revisit.alias("revisit"), "row", F.col("best")["row"].alias("refers_row"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: _Bundle | None = None
        for batch in batches:
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                id, url, payload, digest, refers_to, revisit, row, refers_row = (c[i].as_py() for c in batch.columns)
                if bundle is None:
                    bundle = _Bundle(folder)
                kind, urn = "revisit" if revisit else "response", record_urn(folder, id, row)
                refers = record_urn(folder, refers_to, refers_row) if revisit else ""
                rows += bundle.add(id, record(id, url, payload, digest, refers_to, kind, urn, refers, date))
                if bundle.at >= BUNDLE_BYTES:
                    rows += bundle.close()
                    bundle = None
            if rows:
                yield _batch(rows, _MANIFEST)
        if bundle is not None:
            yield _batch(bundle.close(), _MANIFEST)

    return stored(ready.mapInArrow(run, MANIFEST), "warc-manifest")


def _number(text: str) -> int | None:
    return int(text) if text else None


def _record_row(path: str, head: dict[str, str], payload: bytes) -> tuple:
    kind, said = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != said:
        raise ValueError(f"payload and digest differ in {path}")
    refers = _number(head[REFERS_ID]) if kind == "revisit" else None
    n = len(payload) if kind == "response" else None
    return _number(head[ID]), kind, n, said, refers, head.get("WARC-Target-URI")


def _frame(path: str, offset: int, size: int) -> bytes:
    system, inner = _open(path)
    with system.open_input_file(inner) as file:
        file.seek(offset)
        return zstandard.ZstdDecompressor().decompress(file.read(size))


def _read_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (bundle, offset, size) to the records in these frames; one frame is in memory at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            path, offset, size = (c[i].as_py() for c in batch.columns[:3])
            yield _batch([_record_row(path, h, p) for _, h, p in records(_frame(path, offset, size))], _RECORD)


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (bundle, offset, size, start, length) to the records at these places; rows of one frame follow each other."""
    now, whole = None, b""
    for batch in batches:
        rows = []
        for path, offset, size, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (path, offset) != now:
                now, whole = (path, offset), _frame(path, offset, size)
            ((_, head, payload),) = records(whole[start : start + length])
            rows.append(_record_row(path, head, payload))
        yield _batch(rows, _RECORD)


def read_all(manifest: DataFrame) -> DataFrame:
    """All records of the manifest's bundles, found by the bundles' own seek tables.

    A revisit has no payload, so the size of its payload is looked up at its response, by digest.
    """

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = _open(path)
                with system.open_input_file(inner) as file:
                    table = read_seek_table(file)
                if table:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(table)), *(pa.array(x, pa.int64()) for x in zip(*table, strict=True))],
                        ["bundle", "frame_offset", "frame_bytes"],
                    )

    found = (
        manifest.select("bundle")
        .distinct()
        .mapInArrow(frames, "bundle string, frame_offset long, frame_bytes long")
        .repartition("bundle", "frame_offset")
        .mapInArrow(_read_frames, RECORD)
    )
    return _with_sizes(stored(found, "warc-records"))


def _with_sizes(found: DataFrame) -> DataFrame:
    responses = (
        found.where("record_type = 'response'")
        .groupBy(F.col("payload_digest").alias("of"))
        .agg(F.max("payload_bytes").alias("bytes"))
    )
    revisits = found.where("record_type = 'revisit'")
    sized = revisits.join(responses, revisits["payload_digest"] == responses["of"]).select(
        *[F.col("bytes").alias(c) if c == "payload_bytes" else c for c in found.columns]
    )
    return found.where("record_type = 'response'").unionByName(sized)


def lookup(manifest: DataFrame, ids: DataFrame, id: str = "record_id") -> DataFrame:
    """The records of some ids only, cut out of their frames (revisits without the size of their payload)."""
    wanted = ids.select(F.col(id).cast("long").alias("wanted")).distinct()
    places = manifest.join(wanted, manifest["record_id"] == wanted["wanted"], "left_semi")
    frame = ["bundle", "frame_offset"]
    rows = places.select(*frame, "frame_bytes", "start", "length").repartition(*frame).sortWithinPartitions(*frame)
    return rows.mapInArrow(_read_places, RECORD)


def archive_folder(spark) -> str:
    return scratch_path(spark, "warc")
