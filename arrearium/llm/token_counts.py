"""Token counts by byte-level BPE with a heap and a linked list.

A word's symbols are a doubly linked list, its mergeable neighbours a heap ordered by rank and place.  The best pair
is popped again and again; pairs that a merge has overtaken are skipped.  The count is the initial symbols minus
the merges, so no ids are made, and a word of n bytes takes n log n steps however long it is.

Special strings found in a text count as one token each, as the tokenizer file's library does by default.

Defined results: a null text is empty and has no tokens; repeated rows count each; an empty table gives none.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words whose counts a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Fixed value: how this kind of tokenizer splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: itself, or else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


#: What keeps a text from being cut at its spaces: white space before a space, or separators that count as white
#: space in one library only.
_UNCUT = re.compile(r"\s |[\x1c-\x1f]")


def cut(text: str, pattern: str) -> list[str] | None:
    """The text cut at its spaces, if no match of the pattern can cross a cut.

    The pattern's matches never have white space after other characters, so a space that follows such a character
    begins a match.  None for other patterns and for the few texts with white space before a space.
    """
    return text.split(" ") if pattern == PATTERN and not _UNCUT.search(text) else None


class Merges:
    """Ranks of pairs: left id and right id in one number -> rank and merged symbol in one number."""

    def __init__(self, tokenizer_json: str):
        file = json.loads(tokenizer_json)
        vocab = file["model"]["vocab"]
        self.byte_ids = [0] * 256
        for character, byte in byte_symbols().items():
            self.byte_ids[byte] = vocab[character]
        self.pairs: dict[int, int] = {}
        for rank, merge in enumerate(file["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault(vocab[left] << 24 | vocab[right], rank << 24 | vocab[left + right])
        self.special = sorted((t["content"] for t in file["added_tokens"]), key=len, reverse=True)

    def count(self, word: bytes) -> int:
        """Tokens of one word: its bytes minus the merges."""
        n = len(word)
        if n < 2:
            return n
        pair, ids = self.pairs.get, self.byte_ids
        symbol = [ids[b] for b in word]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            found = pair(symbol[i] << 24 | symbol[i + 1])
            if found is not None:
                heap.append((found >> 24, i))
        heapify(heap)
        merges = 0
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            # Overtaken: this symbol is gone, or it or its neighbour has changed.
            if j >= n or symbol[i] < 0:
                continue
            now = pair(symbol[i] << 24 | symbol[j])
            if now is None or now >> 24 != rank:
                continue
            merges += 1
            merged = symbol[i] = now & 0xFFFFFF
            symbol[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = pair(merged << 24 | symbol[k])
                if found is not None:
                    heappush(heap, (found >> 24, i))
            h = before[i]
            if h >= 0:
                found = pair(symbol[h] << 24 | merged)
                if found is not None:
                    heappush(heap, (found >> 24, h))
        return n - merges


class Counter:
    """Counts whole texts; remembers pieces between spaces, and words."""

    def __init__(self, tokenizer_json: str, pattern: str):
        self.merges = Merges(tokenizer_json)
        self.pattern, self.find = pattern, regex.compile(pattern).findall
        special = self.merges.special
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def count(self, text: str) -> int:
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        pieces = cut(text, self.pattern)
        if pieces is None:
            return self._of_words(text)
        total, known = self._of_words(pieces[0]), self.pieces
        del pieces[0]
        try:
            return total + sum(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                n = self._of_words(" " + piece)
                if len(piece) < 64:
                    known[piece] = n
            total += n
        return total

    def _of_words(self, text: str) -> int:
        total, known = 0, self.words
        if len(known) > REMEMBERED:
            known.clear()
        for word in self.find(text):
            n = known.get(word)
            if n is None:
                n = self.merges.count(word.encode())
                if len(word) < 64:
                    known[word] = n
            total += n
        return total


_COUNTERS: dict[tuple[int, str], Counter] = {}


def token_counts(
    docs: DataFrame, tokenizer_json: str, limit: int = 512, id: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; one pass, no shuffle.

    ``tokenizer_json`` is the content of a byte-level BPE tokenizer file (a vocabulary, of fixed size); it is
    sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    key = (hash(tokenizer_json), pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(key)
        if counter is None:
            counter = _COUNTERS[key] = Counter(shared.value, pattern)
        for batch in batches:
            tokens = [counter.count(t) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    wanted = docs.select(F.col(id).cast("long").alias("doc_id"), size.alias("n_bytes"), F.col(text).alias("text"))
    return wanted.mapInArrow(run, SCHEMA)


def content(spark: SparkSession, path: str) -> str:
    """A vocabulary file's content, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()
