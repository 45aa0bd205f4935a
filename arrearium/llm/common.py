"""Shared helpers: stored tables, blocks of documents, and words and hashes of a batch of texts in numpy.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
Hashes are 64-bit polynomials over the bytes, mixed; two different strings share one with chance 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.session import scratch_path

#: Bytes of text that a block of documents aims at: what one task holds in memory at once.
BLOCK_BYTES = 24_000_000
#: Bytes of text that the numpy helpers work on at once.
CHUNK_BYTES = 1_000_000

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 2**64)
_U = np.uint64
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[int, np.ndarray] = {}


def stored(df: DataFrame, name: str, spent: list[str] | None = None, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a cut of the lineage that survives lost executors.

    ``spent`` gets the folder, for ``forget`` when nothing reads it any more.
    """
    path = scratch_path(df.sparkSession, name)
    if spent is not None:
        spent.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, spent: list[str]) -> None:
    """Delete stored tables that a step needs no more, so that they take no disk while the next ones run."""
    for path in spent:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    spent.clear()


def block_count(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks that give each about ``block_bytes`` of text; one number comes to the driver."""
    total = docs.select(F.sum(F.octet_length(F.col(text)) + F.lit(64))).first()[0]
    return max(1, -(-(total or 0) // block_bytes))


def block_of(*columns: str, blocks: int) -> Column:
    """A block for each row by the hash of its values."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        grown[0] = 1
        have = np.cumprod(grown, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:  # tables for a rare huge text are not kept
            _POWERS[base] = have
    return have


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """C with C[j] - C[i] the unscaled hash of data[i:j]."""
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_P, len(data))[: len(data)], out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] from its prefix hashes."""
    return mix((c[end] - c[start]) * _powers(_P_INV, len(c))[start])


def gram_hash(c: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte strings."""
    n = max(0, len(c) - k)
    return mix((c[k:] - c[:n]) * _powers(_P_INV, max(1, n))[:n])


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (and the last ends); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, min(n, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1, i + 20_000))
        yield i, j
        i = j


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, text index and hash of each; ``first[i]`` is text i's first word."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> Words:
    """All words, the runs of bytes that ``space`` does not mark; none crosses the border of two texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~space[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    border = offsets[:-1][offsets[:-1] < n]
    fresh[border] = inside[border]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    final = offsets[1:][offsets[1:] > 0] - 1
    last[final] = inside[final]
    start, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, text, span_hash(prefix_hash(data), start, end), first)


def shingles_of(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of every run of ``size`` words; a shorter text with a word has one, of all its words."""
    spread = mix(words.hash + _U(0x632BE59BD9B4E019))
    n = len(spread) - size + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if n > 0:
        at = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
        total = np.zeros(len(at), np.uint64)
        for j in range(size):
            total = total * _U(_P) + spread[at + j]
        found.append((mix(total), words.text[at], at))
    counts = words.counts
    for k in range(1, size):
        texts = np.flatnonzero(counts == k)
        total = np.full(len(texts), k, np.uint64)
        for j in range(k):
            total = total * _U(_P) + spread[words.first[texts] + j]
        found.append((mix(total), texts, words.first[texts]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def run_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words with hashes ``h``, from running sums: the cost does not grow with ``size``."""
    n = max(0, len(h) - size + 1)
    c = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h + _U(0x632BE59BD9B4E019)) * _powers(_P, len(h))[: len(h)], out=c[1:])
    return mix((c[size : size + n] - c[:n]) * _powers(_P_INV, max(1, n))[:n] + _U(size))


def id_or_last(column: str) -> Column:
    """A document id as a number; null counts as larger than all."""
    return F.coalesce(F.col(column).cast("long"), F.lit(2**63 - 1))


def as_id(column: Column) -> Column:
    """The opposite of ``id_or_last``."""
    return F.when(column != F.lit(2**63 - 1), column)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
