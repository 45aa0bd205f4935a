"""Byte-level BPE encoding and decoding by tree reduction.

Encoding is a monoid: a word's halves are encoded by recursion and joined.  Greedy merging by rank has this
property: a sequence of tokens is the encoding of its bytes exactly if every two neighbours are the encoding of
their own bytes together.  So a join re-encodes a window around the border, grows it where a token at the window's
edge does not stand with its neighbour outside, and stops when both edges stand: nothing outside can change any
more.  Words of a few bytes, and windows, are merged directly.  Decoding joins the tokens' bytes up a tree.

Defined results: a null text is empty and has no tokens; repeated rows are encoded each; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.token_counts import PATTERN, cut

#: Words of up to so many bytes are merged directly; longer ones by halves.
LEAF = 32
#: Tokens on either side of a border that a join re-encodes first.
MARGIN = 2
#: Words, and pairs of tokens, that a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Tokens that decoding joins directly.
DECODE_LEAF = 4096


class Codec:
    """Encodes and decodes by a rank table: bytes of a token -> its id, lower ids merging first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern, self.find = pattern, regex.compile(pattern).findall
        self.words: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Greedy merging of a short string: the lowest rank first, of equal ones the leftmost."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        score = [ranks.get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
        while score:
            best = min(score)
            if best == 1 << 60:
                break
            i = score.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del score[i]
            if i < len(score):
                score[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                score[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def stands(self, left: int, right: int) -> bool:
        """Whether two neighbours are the encoding of their bytes together."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            both = self.merge(self.bytes_of[left] + self.bytes_of[right])
            known = self.pairs[left, right] = both == [left, right]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded strings together."""
        if not left or not right:
            return left + right
        if self.stands(left[-1], right[0]):
            return left + right
        i, j = MARGIN, MARGIN
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = left[len(left) - i :] + right[:j]
            data = b"".join(map(self.bytes_of.__getitem__, window))
            # A window that has grown long is reduced by halves like any other string.
            fresh = self.merge(data) if len(data) <= 8 * LEAF else self._halves(data)
            low = i == len(left) or self.stands(left[-i - 1], fresh[0])
            high = j == len(right) or self.stands(fresh[-1], right[j])
            if low and high:
                return left[: len(left) - i] + fresh + right[j:]
            i, j = (i if low else 2 * i), (j if high else 2 * j)

    def _halves(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merge(data)
        middle = len(data) // 2
        return self.join(self._halves(data[:middle]), self._halves(data[middle:]))

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.words.get(word)
        if ids is None:
            data = word.encode()
            whole = self.ranks.get(data)  # a word that is a token is that token
            ids = (whole,) if whole is not None else tuple(self._halves(data))
            if len(word) < 64:
                if len(self.words) > REMEMBERED:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _words(self, text: str) -> tuple[int, ...]:
        return tuple(i for word in self.find(text) for i in self.word(word))

    def encode(self, text: str) -> list[int]:
        pieces = cut(text, self.pattern)
        if pieces is None:
            return list(self._words(text))
        out, known = list(self._words(pieces[0])), self.pieces
        add = out.extend
        if len(known) > REMEMBERED:
            known.clear()
        for piece in pieces[1:]:
            ids = known.get(piece)
            if ids is None:
                ids = self._words(" " + piece)
                if len(piece) < 64:
                    known[piece] = ids
            add(ids)
        return out

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        level = [self.decode(ids[i : i + DECODE_LEAF]) for i in range(0, len(ids), DECODE_LEAF)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0]


def ranks_of(path: str) -> dict[bytes, int]:
    """The table of a rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in f if x.strip())}


_CODECS: dict[tuple[int, str], Codec] = {}


def _over(docs: DataFrame, ranks: dict[bytes, int], pattern: str, schema: str, make) -> DataFrame:
    """``make(codec, batch)`` over all batches; the table, of fixed size, is sent to the executors once."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = (hash(frozenset(ranks.items())), pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.get(key)
        if codec is None:
            codec = _CODECS[key] = Codec(shared.value, pattern)
        for batch in batches:
            yield make(codec, batch)

    return docs.mapInArrow(run, schema)


def encoded(
    docs: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """(doc_id, ids): every whole text encoded; one pass, no shuffle."""

    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [codec.encode(t) if t else [] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    wanted = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _over(wanted, ranks, pattern, "doc_id long, ids array<int>", make)


def decoded(
    tokens: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", ids: str = "ids", pattern: str = PATTERN
) -> DataFrame:
    """(doc_id, data): the bytes of every row of ids; null ids give empty bytes."""

    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        data = [codec.decode(x) if x else b"" for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    wanted = tokens.select(F.col(id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return _over(wanted, ranks, pattern, "doc_id long, data binary", make)


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, ids and bytes staying in the task."""

    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, ids_hash, bytes_hash = [], [], []
        for t in batch.column(1).to_pylist():
            ids = codec.encode(t) if t else []
            n.append(len(ids))
            ids_hash.append(hashlib.sha256(repr(ids)[1:-1].replace(" ", "").encode()).hexdigest())
            bytes_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(bytes_hash, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    wanted = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _over(wanted, ranks, pattern, schema, make)
