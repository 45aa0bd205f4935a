"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Each text is encoded by a byte-level BPE (A) and a piece model (B).  Where tokens of both end at the same byte, a group
ends, and the two tokens that end there are linked.  Documents are numbered within boxes, each of bounded text and of
at most 65,536 documents.  For every pair of token ids a box keeps an inverted list: compressed bitmaps of its
documents, one for each binary digit of the number of links (multiplicity planes).  Batches are OR-merged into the box;
popcounts of the planes give a pair's documents and links, sums over boxes the corpus-wide counts.  Scores go back along
the postings: a box gets the scores of its own pairs and adds them to the documents in each plane.

A pair that every document has is one row per box, so nothing is hot; a box is bounded, and so is what one task joins.

Texts are cut before spaces that follow other characters: no token of either kind crosses such a cut (A's pattern
starts a match there; B has no piece with a space behind another character, which is checked).  Pieces are remembered.
Texts with white space before a space, or with a piece that does not come back byte for byte, are encoded whole.

Defined results: a null or empty text, and one whose joined tokens differ from its bytes behind a space, has no tokens:
zeros and an empty hash.  Repeated rows and null ids are documents of their own; an empty table gives none; other columns
are not looked at.  Texts of any length are aligned whole; a long one fills a box alone.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearium.llm.common import stored
from arrearium.llm.token_counts import PATTERN, byte_symbols, cut

#: Characters of text, and documents, of a box.
BOX_CHARS = 6_000_000
BOX_DOCS = 65_536
#: Documents of a bitmap that are listed one by one; above this it is a plain bitmap of BOX_DOCS bits.
LISTED = 4096
#: Pieces between spaces that a worker remembers; the memory is emptied when it is full.
REMEMBERED = 300_000
#: Pieces that are aligned together.
TOGETHER = 4000
#: Rows that a task hands out at once.
BATCH = 20_000

STORED = (
    "box long, a int, b int, docs long, links long, planes binary, "
    "at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_POSTING = pa.schema([("box", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64()), ("links", pa.int64()), ("planes", pa.binary())])
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]

#: A group of texts' tokens: A tokens, B tokens, groups, the groups' text, the linked pairs packed as 64-bit numbers.
Aligned = tuple[int, int, int, str, bytes]
NOTHING: Aligned = (0, 0, 0, "", b"")


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, tokenizer_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        file = json.loads(tokenizer_json)
        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        symbols = byte_symbols()
        vocab = file["model"]["vocab"]
        bytes_a = [b""] * (1 + max([*vocab.values(), *[t["id"] for t in file["added_tokens"]]]))
        for token, i in vocab.items():
            bytes_a[i] = bytes(symbols.get(c, 0) for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.length_a, self.length_b = (np.array([len(x) for x in side]) for side in (bytes_a, bytes_b))
        # An id with what follows it: within its group, at the end of a group's A or B tokens, at the end of a text.
        self.written = [f"{i}{end}" for side, ends in ((bytes_a, ",|"), (bytes_b, ",;\n")) for end in ends for i in range(len(side))]
        self.cuts = file.get("normalizer") is None and not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, Aligned | None] = {}

    def align(self, texts: list[str]) -> list[Aligned] | None:
        """Texts aligned together, a space before each; None if their tokens are not their bytes or cross two texts."""
        joined = " ".join(texts)
        ids_a = self.a.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids
        ids_b = self.b.encode(joined, num_threads=1)
        whole = b" " + joined.encode()
        if any(b"".join(map(of.__getitem__, ids)) != whole for of, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
            return None
        a, b = np.array(ids_a), np.array(ids_b)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        until = np.cumsum([1 + len(t.encode()) for t in texts])
        last = np.searchsorted(ends, until)
        if not np.array_equal(ends[last], until):
            return None
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        # Before an A token stand the B tokens of earlier groups; before a B token the A tokens up to its own group's.
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.r_[0, link_b + 1][group_a]] = a + len(self.bytes_a) * (ends[group_a] == ends_a)
        end = (ends[group_b] == ends_b).astype(np.int64)
        end[link_b[last]] = 2
        order[np.arange(len(b)) + link_a[group_b] + 1] = 2 * len(self.bytes_a) + b + len(self.bytes_b) * end
        groups = "".join(map(self.written.__getitem__, order.tolist())).split("\n")
        links = (a[link_a] << 32 | b[link_b]).tobytes()
        n_a, n_b, n = (np.diff(x, prepend=-1).tolist() for x in (link_a[last], link_b[last], last))
        at = [0, *(8 * (last + 1)).tolist()]
        return [(*x, links[i:j]) for *x, i, j in zip(n_a, n_b, n, groups, at, at[1:], strict=False)]

    def aligned(self, texts: list[str | None]) -> Iterator[Aligned]:
        """The alignment of each text; their new pieces are learned first."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        pieces = [self._cut(t) if t else None for t in texts]
        fresh = {p for found in pieces if found for p in found} - self.known.keys() - {""}
        # A piece with white space at its end would meet the next one's space.
        together = [p for p in fresh if not p[-1].isspace()]
        for i in range(0, len(together), TOGETHER):
            part = together[i : i + TOGETHER]
            self.known.update(zip(part, self.align(part) or map(self._alone, part), strict=True))
        self.known.update((p, self._alone(p)) for p in fresh if p[-1].isspace())
        for text, found in zip(texts, pieces, strict=True):
            parts = [None] if found is None else list(map(self.known.get, found))
            if not text:
                yield NOTHING
            elif None in parts:  # cannot be cut, ends in a space, or has a piece that does not come back
                yield (self.align([text]) or [NOTHING])[0]
            else:
                a, b, n, groups, links = (map(itemgetter(k), parts) for k in range(5))
                yield sum(a), sum(b), sum(n), ";".join(groups), b"".join(links)

    def _alone(self, piece: str) -> Aligned | None:
        found = self.align([piece])
        return found and found[0]

    def _cut(self, text: str) -> list[str] | None:
        if not self.cuts:
            return None
        pieces = cut(" " + text, PATTERN)
        return None if pieces is None else pieces[1:]


class Box:
    """Postings of the documents of one box: pairs, places and links of each batch until they are merged."""

    def __init__(self, number: int):
        self.number, self.chars, self.docs = number, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, pairs: bytes, chars: int) -> int:
        """One document's links; its place in the box."""
        at, self.docs, self.chars = self.docs, self.docs + 1, self.chars + chars
        if pairs:
            pair, times = np.unique(np.frombuffer(pairs, np.int64), return_counts=True)
            self.parts.append((pair, np.full(len(pair), at, np.uint16), times.astype(np.uint32)))
        return at

    @property
    def full(self) -> bool:
        return self.chars >= BOX_CHARS or self.docs >= BOX_DOCS

    def postings(self) -> Iterator[pa.RecordBatch]:
        """A row for every pair: documents, links and the packed planes."""
        if not self.parts:
            return
        pair, at, times = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(pair, kind="stable")
        pair, at, times = pair[order], at[order], times[order]
        cuts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1], True])
        keys, packed = pair[cuts[:-1]], [b""] * (len(cuts) - 1)
        links = np.zeros(len(keys), np.int64)
        for plane in range(int(times.max()).bit_length()):
            held = (times >> np.uint32(plane) & 1).astype(bool)
            docs = at[held]
            ends = np.r_[0, np.cumsum(held)][cuts]
            count = np.diff(ends)
            links += count << plane
            for k in np.flatnonzero(count).tolist():
                packed[k] += pack(plane, docs[ends[k] : ends[k + 1]])
        n = np.diff(cuts)
        for i in range(0, len(keys), BATCH):
            part = slice(i, i + BATCH)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys[part]), self.number)), pa.array((keys[part] >> 32).astype(np.int32)),
                    pa.array((keys[part] & 0xFFFFFFFF).astype(np.int32)), pa.array(n[part]), pa.array(links[part]), pa.array(packed[part], pa.binary()),
                ],
                schema=_POSTING,
            )


_LIST, _MAP = 0, 1


def pack(plane: int, docs: np.ndarray) -> bytes:
    """One plane: its digit, its kind, its cardinality less one, then the documents in order, or a bitmap if they are many."""
    kind = _LIST if len(docs) <= LISTED else _MAP
    head = np.array([plane << 1 | kind, len(docs) - 1], np.uint16).tobytes()
    if kind == _LIST:
        return head + docs.tobytes()
    bits = np.zeros(BOX_DOCS, bool)
    bits[docs] = True
    return head + np.packbits(bits, bitorder="little").tobytes()


def planes(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(digit, documents) of every plane of a packed row."""
    at = 0
    while at < len(data):
        head, count = np.frombuffer(data, np.uint16, 2, at).tolist()
        at += 4
        if head & 1 == _LIST:
            docs = np.frombuffer(data, np.uint16, count + 1, at)
            at += 2 * (count + 1)
        else:
            docs = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, BOX_DOCS // 8, at), bitorder="little"))
            at += BOX_DOCS // 8
        yield head >> 1, docs


_TOKENIZERS: dict[int, Tokenizers] = {}


def postings(docs: DataFrame, tokenizer_json: str, piece_model: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored rows of two kinds: a pair in a box with its planes (``a`` is set), and a document in a box (``at`` is set).

    Boxes get their numbers in the task, so the rows are stored before anything is joined by them.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, piece_model))
    key = hash((tokenizer_json, piece_model))
    schema = pa.schema(
        [*_POSTING, ("at", pa.int32()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string())]
    )

    def filled(batch: pa.RecordBatch) -> pa.RecordBatch:
        have = dict(zip(batch.schema.names, batch.columns, strict=True))
        return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(batch.num_rows, f.type)) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _TOKENIZERS.get(key)
        if tokenizers is None:
            tokenizers = _TOKENIZERS[key] = Tokenizers(*shared.value)
        number = TaskContext.get().partitionId() << 32
        box, told = Box(number), []

        def documents() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.int64()] * 4, pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*told, strict=True), kinds, strict=True)]
            return filled(pa.RecordBatch.from_arrays(arrays, ["box", "at", "doc_id", *_COUNTS, "groups_sha256"]))

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(texts), 256):
                part = texts[i : i + 256]
                for doc, said, (a, b, n, groups, links) in zip(ids[i : i + 256], part, tokenizers.aligned(part), strict=True):
                    digest = hashlib.sha256(groups.encode()).hexdigest() if n else ""
                    told.append((box.number, box.add(links, len(said or "")), doc, a, b, n, len(links) // 8, digest))
                    if box.full:
                        yield from map(filled, box.postings())
                        number += 1
                        box = Box(number)
            if told:
                yield documents()
                told.clear()
        yield from map(filled, box.postings())

    wanted = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return stored(wanted.mapInArrow(run, STORED), "postings")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, docs, links): documents and links of every pair in the corpus, from the popcounts of the boxes."""
    return rows.where(F.col("a").isNotNull()).groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def aligned(rows: DataFrame) -> DataFrame:
    """One row per document from ``postings``: its counts, and the scores that its links get back."""
    # At most a vocabulary of pairs share a B id.
    best = F.col("links") == F.max("links").over(Window.partitionBy("b"))
    scored = pair_counts(rows).select("a", "b", "links", best.alias("best"))
    asked = rows.where(F.col("a").isNotNull()).select("box", "a", "b")
    scores = asked.join(scored, ["a", "b"]).select(*[F.col(c).alias(c) for c in ("box", "a", "b", "links", "best")])
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        is_doc = own.column("at").is_valid()
        docs, lists = own.filter(is_doc), own.filter(own.column("a").is_valid())
        key = lambda t: t.column("a").to_numpy().astype(np.int64) << 32 | t.column("b").to_numpy()
        total, most = np.zeros(BOX_DOCS, np.int64), np.zeros(BOX_DOCS, np.int64)
        if lists.num_rows:
            mine, theirs = key(lists), key(got)
            place = np.argsort(theirs)
            place = place[np.searchsorted(theirs, mine, sorter=place)]
            count, top = got.column("links").to_numpy()[place].tolist(), got.column("best").to_numpy()[place].tolist()
            for data, n, is_best in zip(lists.column("planes").to_pylist(), count, top, strict=True):
                for digit, at in planes(data):
                    total[at] += n << digit
                    if is_best:
                        most[at] += 1 << digit
        at = docs.column("at").to_numpy()
        out = {name: docs.column(name) for name in names if name in docs.column_names}
        out |= {"n_best": pa.array(most[at]), "count_sum": pa.array(total[at])}
        return pa.table([out[name] for name in names], names)

    return rows.select("box", "a", "b", "planes", "at", "doc_id", *_COUNTS, "groups_sha256").groupBy("box").cogroup(
        scores.groupBy("box")
    ).applyInArrow(run, ALIGNED)
