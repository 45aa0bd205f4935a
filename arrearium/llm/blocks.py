"""Rounds between blocks of documents and buckets of keys.

Documents lie in blocks of a bounded size.  A block sends its distinct keys, packed, to the buckets that own them; a
bucket sends each block an answer about its keys.  A key that a third of all documents have reaches its bucket once per
block, so no bucket is hot, and packed keys take a few bytes each.  Blocks and buckets are groups of a Spark shuffle;
several rounds in one plan share the one shuffle of the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import BLOCK_BYTES, block_count, block_of, id_or_last

SENT = "bucket int, block int, data binary"
ANSWER = "block int, kind int, data binary"


def in_blocks(docs: DataFrame, id: str, text: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, id, text) of all rows and the number of blocks.

    The id and the text choose the block, so exact copies under other ids, and rows without an id, are spread.
    """
    n = block_count(docs, text, block_bytes)
    rows = docs.select(id_or_last(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select(block_of("id", "text", blocks=n).alias("block"), "id", "text"), n


def _sent(parts: Iterable[tuple[int, bytes]], block: int) -> pa.Table:
    buckets, data = [], []
    for bucket, packed in parts:
        buckets.append(bucket)
        data.append(packed)
    return pa.table(
        {
            "bucket": pa.array(buckets, pa.int32()),
            "block": pa.array([block] * len(buckets), pa.int32()),
            "data": pa.array(data, pa.binary()),
        }
    )


def by_bucket(
    rows: np.ndarray, bucket: np.ndarray, write: Callable[[np.ndarray], bytes] = np.ndarray.tobytes
) -> Iterable[tuple[int, bytes]]:
    """Structured rows packed by bucket."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for part, at in zip(np.split(rows, cuts), [0, *cuts], strict=True):
        if len(part):
            yield int(bucket[at]), write(part)


def _block(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def send(blocks: DataFrame, make: Callable[[pa.Table], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """``make(table)`` of every block: (bucket, packed keys)."""
    return blocks.groupBy("block").applyInArrow(lambda t: _sent(make(t), _block(t)), SENT)


def send_knowing(
    blocks: DataFrame, answers: DataFrame, make: Callable[[pa.Table, dict[int, list[bytes]]], Iterable[tuple[int, bytes]]]
) -> DataFrame:
    """As ``send``; ``make`` also gets the block's answers by kind."""

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        return _sent(make(table, _kinds(got)), _block(table)) if table.num_rows else _sent([], 0)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SENT)


def _kinds(got: pa.Table) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for kind, data in zip(got.column("kind").to_pylist(), got.column("data").to_pylist(), strict=True):
        out.setdefault(kind, []).append(data)
    return out


def answer(
    sent: DataFrame, kind: int, dtype: np.dtype,
    make: Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]],
    read: Callable[[bytes, int], np.ndarray] | None = None, write: Callable[[np.ndarray], bytes] = np.ndarray.tobytes,
) -> DataFrame:
    """``make(rows, block of each, bucket)`` of every bucket: (answer rows, block of each).

    Rows lie in messages and answers as they are, or as ``read(message, bucket)`` and ``write(rows)`` have them.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        sent = [read(d, bucket) if read else np.frombuffer(d, dtype) for d in table.column("data").to_pylist()]
        block = np.repeat(np.array(table.column("block").to_pylist(), np.int32), [len(rows) for rows in sent])
        out, of = make(np.concatenate(sent), block, bucket)
        parts = list(by_bucket(out, of, write))
        return pa.table(
            {
                "block": pa.array([b for b, _ in parts], pa.int32()),
                "kind": pa.array([kind] * len(parts), pa.int32()),
                "data": pa.array([d for _, d in parts], pa.binary()),
            }
        )

    return sent.groupBy("bucket").applyInArrow(run, ANSWER)


def finish(
    blocks: DataFrame, answers: DataFrame, make: Callable[[pa.Table, dict[int, list[bytes]]], pa.Table], schema: str,
    empty: pa.Schema,
) -> DataFrame:
    """``make(table, answers by kind)`` of every block."""

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        return make(table, _kinds(got)) if table.num_rows else empty.empty_table()

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def unpack(parts: list[bytes] | None, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(parts or []), dtype)


def columns(rows: np.ndarray, *order: str) -> dict[str, np.ndarray]:
    """The fields of structured rows as arrays of their own, in order of some fields: quicker to sort and search."""
    at = np.lexsort([rows[name] for name in reversed(order)])
    return {name: rows[name][at] for name in rows.dtype.names}


def group_min(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest value of each, and the place of every row's key."""
    keys, place = np.unique(key, return_inverse=True)
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, place, value)
    return keys, least, place


def find(sorted_keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted ones, and where."""
    if len(sorted_keys) == 0:
        return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, key), len(sorted_keys) - 1)
    return sorted_keys[at] == key, at
