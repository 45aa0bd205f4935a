"""Removal of repeated byte strings by distributed prefix doubling over thinned positions.

A byte goes if a string of ``length`` bytes (50) over it also starts in a document with a smaller id.  Plain prefix
doubling ranks every position by one byte, then pairs of ranks at offsets 1, 2, 4, ...; here it begins with ranks of
25 bytes and at one position in about 13: every string of 50 bytes owns its smallest 25-byte rank (the leftmost
of equal ones), its anchor, and equal strings own anchors at the same place.  Then the offsets grow:

1. ranks of 25 bytes at the anchors; anchors whose rank no other document has are unique and leave;
2. the ranks at offsets -25, 0 and 25 of an anchor (75 bytes): where a smaller document has the same, all
   strings of that anchor repeat;
3. for the rest of each 25-byte rank, the pairs of ranks at offsets 0 and 25 of every string: the threshold of 50.

A rank is a 64-bit number of the string itself, so ranks agree between tasks without a global sort; step 1 uses
fewer bits, as a chance agreement there only adds work.  Each step is a round between blocks and buckets (blocks.py).

Defined results: a null text is empty; texts below ``length`` lose nothing; a null id counts as larger than all and
documents without id do not remove from each other; rows repeated with one id are one document; an empty table gives
none.  Matches never cross documents; other columns do not pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm import blocks as rounds
from arrearium.llm.common import BLOCK_BYTES, as_id, chunks, gram_hash, mix, prefix_hash, span_hash, texts_of

LENGTH = 50

_U = np.uint64
_GRAM = np.dtype([("k", "<u4"), ("many", "u1")])
_GRAM_SAID = np.dtype([("k", "<u8")])
_AROUND = np.dtype([("c", "<u8"), ("g", "<u4"), ("id", "<i8")])
_AROUND_SAID = np.dtype([("c", "<u8"), ("least", "<i8"), ("more", "u1")])
_STRING = np.dtype([("s", "<u8"), ("id", "<i8")])


def _leftmost_smallest(h: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, where the smallest is by its upper half, the leftmost of equal ones."""
    value, have = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * have <= width:
        value = np.minimum(value[:-have], value[have:])
        have *= 2
    if have < width:
        value = np.minimum(value[: have - width], value[width - have :])
    return value.astype(np.uint32)


class Anchors:
    """The anchors of a range of texts: place, first and last string that own each, and ranks.

    All places are counted from the range's first byte.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        k = length // 2
        width = length - k + 1
        self.length, self.k = length, k
        self.prefix = prefix_hash(data)
        none = np.zeros(0, np.int64)
        self.at = self.first = self.last = self.text = none
        self.gram = self.around = none.astype(np.uint64)
        if len(data) < length:
            return
        grams = gram_hash(self.prefix, k)
        place = _leftmost_smallest(grams, width)
        # Only strings inside one text count: a text's last starts are not.
        inside = np.ones(len(place), bool)
        for low, high in zip(offsets[:-1], offsets[1:], strict=True):
            inside[max(low, high - length + 1) : high] = False
        edge = np.ones(len(place) + 1, bool)
        edge[1:-1] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
        cuts = np.flatnonzero(edge)
        head, tail = cuts[:-1], cuts[1:] - 1
        own = inside[head]
        self.first, self.last = head[own], tail[own]
        if len(self.first) == 0:
            return
        self.at = place[self.first].astype(np.int64)
        self.text = np.searchsorted(offsets, self.first, "right") - 1
        self.gram = grams[self.at]
        low = np.maximum(offsets[self.text], self.at - width + 1)
        high = np.minimum(offsets[self.text + 1], self.at + length)
        shape = ((self.at - low) * 1024 + (high - self.at)).astype(np.uint64)
        self.around = mix(span_hash(self.prefix, low, high) ^ mix(shape + _U(1)))

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank, start, anchor) of all strings that own the given anchors: pairs of ranks at offsets 0 and k."""
        count = (self.last - self.first + 1)[which]
        anchor = np.repeat(which, count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[which], count)
        k, n = self.k, self.length
        left = span_hash(self.prefix, start, start + k)
        right = span_hash(self.prefix, start + n - k, start + n)
        return mix(left * _U(0x9E3779B97F4A7C15) + right), start, anchor


def _ranges(table: pa.Table, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Anchors]]:
    """(bytes, offsets, ids, anchors) of ranges of a block's texts."""
    data, offsets = texts_of(table.column("text"))
    ids = table.column("id").to_numpy()
    for i, j in chunks(offsets):
        own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        yield own, at, ids[i:j], Anchors(own, at, length)


def _bucket(rank: np.ndarray, buckets: int) -> np.ndarray:
    return ((rank >> _U(32)) % _U(buckets)).astype(np.int32)


def _send_grams(length: int, buckets: int):
    def make(table: pa.Table) -> Iterable[tuple[int, bytes]]:
        got = [(a.gram, ids[a.text]) for _, _, ids, a in _ranges(table, length)]
        gram, id = (np.concatenate(x) for x in zip(*got, strict=True))
        keys, least, place = rounds.group_min(gram, id)
        many = np.zeros(len(keys), bool)
        many[place[id != least[place]]] = True
        rows = np.zeros(len(keys), _GRAM)
        rows["k"], rows["many"] = keys & _U(0xFFFFFFFF), many
        return rounds.by_bucket(rows, _bucket(keys, buckets))

    return make


def _repeated_grams(rows: np.ndarray, block: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each block's ranks those that occur in two documents, as bucket and low bits in one number."""
    keys, place, n = np.unique(rows["k"], return_inverse=True, return_counts=True)
    many = n > 1
    many[place[rows["many"] > 0]] = True
    keep = many[place]
    out = np.zeros(int(keep.sum()), _GRAM_SAID)
    out["k"] = rows["k"][keep].astype(np.uint64) | _U(bucket << 32)
    return out, block[keep]


def _send_around(length: int, buckets: int):
    def make(table: pa.Table, answers: dict[int, list[bytes]]) -> Iterable[tuple[int, bytes]]:
        known = np.sort(rounds.unpack(answers.get(1), _GRAM_SAID)["k"])
        got = []
        for _, _, ids, a in _ranges(table, length):
            key = (_bucket(a.gram, buckets).astype(np.uint64) << _U(32)) | (a.gram & _U(0xFFFFFFFF))
            in_two, _ = rounds.find(known, key)
            got.append((a.around[in_two], a.gram[in_two], ids[a.text[in_two]]))
        around, gram, id = (np.concatenate(x) for x in zip(*got, strict=True))
        keys, least, place = rounds.group_min(around, id)
        grams = np.zeros(len(keys), np.uint64)
        grams[place] = gram
        rows = np.zeros(len(keys), _AROUND)
        rows["c"], rows["g"], rows["id"] = keys, grams & _U(0xFFFFFFFF), least
        return rounds.by_bucket(rows, _bucket(grams, buckets))

    return make


def _least_around(rows: np.ndarray, block: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest document of each 75-byte rank, and whether its 25-byte rank has larger ones to be looked at closely."""
    keys, least, place = rounds.group_min(rows["c"], rows["id"])
    grams = np.zeros(len(keys), np.uint32)
    grams[place] = rows["g"]
    _, low, of = rounds.group_min(grams, least)
    _, high, _ = rounds.group_min(grams, -least)
    more = low[of] < -high[of]
    out = np.zeros(len(rows), _AROUND_SAID)
    out["c"], out["least"], out["more"] = rows["c"], least[place], more[place]
    keep = (out["least"] < rows["id"]) | (out["more"] > 0)
    return out[keep], block[keep]


def _closer(said: dict[str, np.ndarray], a: Anchors, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors to be looked at string by string, smallest document of each anchor's 75-byte rank where known)."""
    there, at = rounds.find(said["c"], a.around)
    least = np.full(len(a.at), np.iinfo(np.int64).max)
    least[there] = said["least"][at[there]]
    if len(said["c"]) == 0:
        return np.zeros(0, np.int64), least
    return np.flatnonzero(there & (said["more"][at] > 0) & (ids[a.text] == least)), least


def _send_strings(length: int, buckets: int):
    def make(table: pa.Table, answers: dict[int, list[bytes]]) -> Iterable[tuple[int, bytes]]:
        said = rounds.columns(rounds.unpack(answers.get(2), _AROUND_SAID), "c")
        got = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for _, _, ids, a in _ranges(table, length):
            which, _ = _closer(said, a, ids)
            rank, _, anchor = a.strings(which)
            got.append((rank, ids[a.text[anchor]]))
        rank, id = (np.concatenate(x) for x in zip(*got, strict=True))
        keys, least, _ = rounds.group_min(rank, id)
        rows = np.zeros(len(keys), _STRING)
        rows["s"], rows["id"] = keys, least
        return rounds.by_bucket(rows, _bucket(keys, buckets))

    return make


def _least_strings(rows: np.ndarray, block: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    _, least, place = rounds.group_min(rows["s"], rows["id"])
    out = rows.copy()
    out["id"] = least[place]
    keep = out["id"] < rows["id"]
    return out[keep], block[keep]


_RESULT = pa.schema(
    [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def _removed(length: int, keep_text: bool):
    """A block's documents without what repeats."""

    def make(table: pa.Table, answers: dict[int, list[bytes]]) -> pa.Table:
        said = rounds.columns(rounds.unpack(answers.get(2), _AROUND_SAID), "c")
        strings = rounds.columns(rounds.unpack(answers.get(3), _STRING), "s")
        # The smallest document of each rank inside the block; those of other blocks are in the answers.
        got, near = [], [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for _, _, ids, a in _ranges(table, length):
            got.append((a.around, ids[a.text]))
            which, _ = _closer(said, a, ids)
            rank, _, anchor = a.strings(which)
            near.append((rank, ids[a.text[anchor]]))
        keys, local, _ = rounds.group_min(*(np.concatenate(x) for x in zip(*got, strict=True)))
        ranks, least_rank, _ = rounds.group_min(*(np.concatenate(x) for x in zip(*near, strict=True)))
        elsewhere, at = rounds.find(strings["s"], ranks)
        least_rank[elsewhere] = np.minimum(least_rank[elsewhere], strings["id"][at[elsewhere]])
        out: dict[str, list] = {f.name: [] for f in _RESULT}
        for data, offsets, ids, a in _ranges(table, length):
            which, least = _closer(said, a, ids)
            if len(keys):
                least = np.minimum(least, local[np.searchsorted(keys, a.around)])
            whole = ids[a.text] > least
            cover = np.zeros(len(data) + 1, np.int32)
            np.add.at(cover, a.first[whole], 1)
            np.add.at(cover, a.last[whole] + length, -1)
            rank, start, anchor = a.strings(which)
            there = least_rank[np.searchsorted(ranks, rank)] < ids[a.text[anchor]] if len(rank) else np.zeros(0, bool)
            np.add.at(cover, start[there], 1)
            np.add.at(cover, start[there] + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            border = offsets[:-1][offsets[:-1] < len(data)]
            begins[border] = gone[border]
            total, spans = (np.concatenate(([0], np.cumsum(x))) for x in (gone, begins))
            out["id"].append(ids)
            out["n_bytes"].append(np.diff(offsets))
            out["n_removed"].append(np.diff(total[offsets]))
            out["n_spans"].append(np.diff(spans[offsets]))
            for i in range(len(ids)):
                low, high = offsets[i], offsets[i + 1]
                kept = data[low:high][~gone[low:high]].tobytes()
                out["kept"].append(kept if keep_text else hashlib.sha256(kept).digest())
        kept = pa.array(out.pop("kept"), pa.binary())
        return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in out.values()] + [kept], schema=_RESULT)

    return make


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` is the bytes left, or their SHA-256 if not ``keep_text``."""
    own, n = rounds.in_blocks(docs, id, text, block_bytes)
    grams = rounds.answer(rounds.send(own, _send_grams(length, n)), 1, _GRAM, _repeated_grams)
    around = rounds.answer(rounds.send_knowing(own, grams, _send_around(length, n)), 2, _AROUND, _least_around)
    strings = rounds.answer(rounds.send_knowing(own, around, _send_strings(length, n)), 3, _STRING, _least_strings)
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    found = rounds.finish(own, around.unionByName(strings), _removed(length, keep_text), schema, _RESULT)
    return found.select(as_id(F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
