"""Documents that contain benchmark passages, found by latent semantic retrieval and checked word by word.

1. Passages of all documents (64 words each) are rows of a TF-IDF matrix A over hashed words.  One pass sums the
   document frequencies and the sketch of A'A by a random matrix; from it a randomised SVD (Nystrom's form) gives
   the leading right singular vectors.  The sketch has a fixed size, whatever the corpus.
2. A second pass gives every window of the documents its vector in the latent space, whitened, and compares it with
   the benchmark items about as long: the query set, in blocks of bounded size.  Windows whose cosine reaches
   ``cosine`` are candidates.
3. A candidate's words are aligned with the item's: a longest common subsequence of ``verbatim`` of the item's words
   is a leak; one of ``paraphrase`` is a leak if the item's answer (its last sentence) occurs too, in one run.

Words here are runs of letters and digits with ASCII letters in lower case; everything outside ASCII is a letter.

Items of less than ``LEAST_WORDS`` words say little in the latent space: they must occur as one run, which is looked for
by the hashes of all runs of their length; their cosine is that of equal words, 1.

Defined results: a null text, or an item without words, matches nothing; items repeated under one id give a row each only
once; a null id is kept; an empty corpus or benchmark gives no rows; texts of any length are read whole; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import chunks, run_hash, texts_of, words_of

#: Hashed words, latent dimensions, words in a passage and in a unit of a window.
FEATURES, DIMENSIONS, PASSAGE, UNIT = 1 << 14, 48, 64, 8
COSINE, VERBATIM, PARAPHRASE, LEAST_WORDS = 0.45, 0.75, 0.5, 8
#: Bytes of benchmark text in one block of queries; a longer benchmark takes a pass over the documents per block.
QUERY_BYTES = 4_000_000
#: Bytes of text worked on at once: their words' vectors stay in a core's cache.
RANGE_BYTES = 60_000
#: Numbers of 64 bits that mark which words a stretch has.
MARKS = 8
#: Rows of the sketch that are added up together.
STRIPES = 16

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, word hashes, first word of each text) of ranges of a column."""
    data, offsets = texts_of(column)
    for i, j in chunks(offsets, RANGE_BYTES):
        own = _LOWER[data[offsets[i] : offsets[j]]]
        words = words_of(own, offsets[i : j + 1] - offsets[i], _BREAK)
        yield i, j, words.hash, words.first


def _feature(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def _random(seed: int, dimensions: int) -> np.ndarray:
    """The random matrix, the same in every task."""
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((FEATURES, dimensions)).astype(np.float32)


def _units(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``size`` words begin (the last run of a text may be shorter), and the first run of each text."""
    n = -(-np.diff(first) // size)
    begin = np.concatenate(([0], np.cumsum(n)))
    text = np.repeat(np.arange(len(n)), n)
    return first[text] + (np.arange(begin[-1]) - begin[text]) * size, begin


def _sketch(seed: int, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, total = _random(seed, dimensions), np.zeros((FEATURES, dimensions + 1))
        passages = 0
        for batch in batches:
            for _, _, h, first in _words(batch.column(0)):
                if len(h) == 0:
                    continue
                start, _ = _units(first, PASSAGE)
                passages += len(start)
                feature = _feature(h).astype(np.uint16)
                rows = np.add.reduceat(random[feature], start)  # each passage times the random matrix
                passage = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(h))))
                order = np.argsort(feature, kind="stable")  # by word, and by passage within
                feature, passage = feature[order].astype(np.int64), passage[order]
                new_word = np.append(True, feature[1:] != feature[:-1])
                head = np.flatnonzero(new_word)
                total[feature[head], :dimensions] += np.add.reduceat(rows[passage], head)
                new_pair = new_word | np.append(True, passage[1:] != passage[:-1])
                total[feature[head], dimensions] += np.add.reduceat(new_pair.astype(np.int64), head)
        if passages:
            parts = [p.astype(np.float32).tobytes() for p in np.split(total, STRIPES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(STRIPES), pa.int32()), pa.array([passages] * STRIPES, pa.int64()), pa.array(parts)],
                ["stripe", "passages", "data"],
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the stripes that come to a task, one batch in memory at a time."""
    sums: dict[int, list] = {}
    for batch in batches:
        for stripe, passages, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(data, np.float32).astype(np.float64)
            if stripe in sums:
                sums[stripe][0] += passages
                sums[stripe][1] += part
            else:
                sums[stripe] = [passages, part]
    if sums:
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int32()),
                pa.array([sums[k][0] for k in keys], pa.int64()),
                pa.array([sums[k][1].tobytes() for k in keys]),
            ],
            ["stripe", "passages", "data"],
        )


def latent_space(docs: DataFrame, text: str, seed: int = 23, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Each hashed word's whitened latent vector times its weight; None for a corpus without words.

    What comes to the driver is the sketch: FEATURES rows of DIMENSIONS + 1 numbers.
    """
    schema = "stripe int, passages long, data binary"
    parts = docs.select(F.col(text)).mapInArrow(_sketch(seed, dimensions), schema)
    sums = parts.repartition(STRIPES, "stripe").mapInArrow(_added, schema).collect()
    if not sums:
        return None
    stripes = {r["stripe"]: np.frombuffer(r["data"]).reshape(-1, dimensions + 1) for r in sums}
    total = np.concatenate([stripes[k] for k in range(STRIPES)])
    passages = sums[0]["passages"]
    sketch, frequency = total[:, :dimensions], total[:, dimensions]
    # A = T D with T the word counts of each passage and D the weights: A'A times (random / D) is D times the sketch.
    weight = np.log((2 + passages) / (1 + frequency))[:, None]
    random = _random(seed, dimensions).astype(np.float64)
    core = random.T @ sketch
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > values[-1] * 1e-9
    basis = (weight * sketch) @ (vectors[:, good] / np.sqrt(values[good]))
    left, singular, _ = np.linalg.svd(basis, full_matrices=False)
    strong = singular > singular[0] * 1e-6
    return (weight * left[:, strong] / singular[strong]).astype(np.float32)


@dataclass
class Items:
    """A block of benchmark items: ids, word hashes, answers, and unit vectors by window length.

    ``short`` has those of less than LEAST_WORDS words by their number of words: hashes of the whole runs, and items.
    """

    ids: list[int | None]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    sets: list[frozenset]
    sizes: np.ndarray
    marks: np.ndarray
    by_units: dict[int, tuple[np.ndarray, np.ndarray]]
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def _marks(h: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """For each owner the bits of its words."""
    marks = np.zeros(owners * MARKS, np.uint64)
    np.bitwise_or.at(marks, owner * MARKS + (h % _U(MARKS)).astype(np.int64), _U(1) << (h >> _U(8)) % _U(64))
    return marks.reshape(owners, MARKS)


def _answer(text: str) -> str:
    """The last sentence of an item."""
    parts = [p for p in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if p.strip()]
    return parts[-1] if parts else ""


def _prepared(rows: list[tuple[int | None, str | None]], space: np.ndarray) -> Items:
    def hashes(texts: list[str]) -> list[np.ndarray]:
        out = []
        for i, j, h, first in _words(pa.array(texts, pa.string())):
            out += [h[first[k] : first[k + 1]] for k in range(j - i)]
        return out

    words = hashes([t or "" for _, t in rows])
    answers = hashes([_answer(t or "") for _, t in rows])
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= LEAST_WORDS:
            groups.setdefault(max(2, 2 * round(len(w) / UNIT / 2)), []).append(i)
    by_units = {}
    for units, members in groups.items():
        vectors = np.stack([space[_feature(words[i])].sum(axis=0) for i in members])
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
        by_units[units] = (np.array(members), np.ascontiguousarray(vectors.T))
    sizes = np.array([len(w) for w in words])
    flat = np.concatenate([*words, np.zeros(0, np.uint64)])
    marks = _marks(flat, np.repeat(np.arange(len(words)), sizes), len(words))
    sets = [frozenset(w.tolist()) for w in words]
    short = {}
    for n in range(1, LEAST_WORDS):
        members = np.flatnonzero(sizes == n)
        if len(members):
            runs = np.concatenate([run_hash(words[i], n) for i in members])
            order = np.argsort(runs, kind="stable")
            short[n] = (runs[order], members[order])
    return Items([i for i, _ in rows], words, answers, sets, sizes, marks, by_units, short)


def _runs(items: Items, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """(text, item) of short items that occur in a text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for n, (runs, members) in items.short.items():
        own = run_hash(h, n)
        low, high = np.searchsorted(runs, own, "left"), np.searchsorted(runs, own, "right")
        whole = text[: len(own)] == text[n - 1 :]
        at = np.flatnonzero((high > low) & whole)
        for t, a, b in set(zip(text[at].tolist(), low[at].tolist(), high[at].tolist(), strict=True)):
            yield from ((t, int(i)) for i in members[a:b])


def _run_in(part: np.ndarray, whole: np.ndarray) -> bool:
    """Whether the words occur in one run."""
    n = len(part)
    if n == 0 or n > len(whole):
        return False
    starts = np.flatnonzero(whole[: len(whole) - n + 1] == part[0])
    return any((whole[s : s + n] == part).all() for s in starts)


def common(item: np.ndarray, words: np.ndarray) -> int:
    """Longest common subsequence, bit-parallel over the item's words."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    row = full = (1 << len(item)) - 1
    for w in words.tolist():
        match = places.get(w)
        if match is not None:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return len(item) - row.bit_count()


def _leak(item: np.ndarray, answer: np.ndarray, words: np.ndarray, verbatim: float, paraphrase: float) -> int:
    """Words of the item found in order, if that is a leak, else 0.

    ``words`` may be several windows long, so the subsequence counts within stretches a little longer than the item.
    """
    n = len(item)
    reach, best = n + max(4, n // 4), 0
    for s in range(0, max(1, len(words) - reach + 1 + n // 4), max(1, n // 4)):
        best = max(best, common(item, words[s : s + reach + n // 4]))
    if best >= verbatim * n or (best >= paraphrase * n and _run_in(answer, words)):
        return best
    return 0


def _candidates(space: np.ndarray, items: Items, h: np.ndarray, first: np.ndarray, cosine: float, share: float):
    """(text, item, first word, end, cosine) of merged runs of similar windows.

    Windows whose surroundings lack too many of the item's words for a subsequence of ``share`` of them are left out;
    the bits that stand for words only ever show fewer words as missing.
    """
    start, begin = _units(first, UNIT)
    units = len(start)
    if units == 0:
        return
    sums = np.add.reduceat(space[_feature(h)], start)
    prefix = np.zeros((units + 1, sums.shape[1]), np.float32)
    np.cumsum(sums, axis=0, out=prefix[1:])
    text = np.repeat(np.arange(len(first) - 1), np.diff(begin))
    final = begin[text + 1]
    own = _marks(h, np.repeat(np.arange(units), np.diff(np.append(start, len(h)))), units)
    for n, (members, vectors) in items.by_units.items():
        # Windows that overlap by half or more, also those cut short by the end of the text.
        step = 1 if n == 2 else 2
        at = np.flatnonzero((np.arange(units) - begin[text]) % step == 0)
        window = prefix[np.minimum(at + n, final[at])] - prefix[at]
        window /= np.maximum(np.sqrt(np.einsum("ij,ij->i", window, window)), 1e-30)[:, None]
        similar = window @ vectors
        place, item = np.nonzero(similar >= cosine)
        # The words that are compared reach up to half an item beyond the window.
        wide = max(1, -(-max(UNIT, int(items.sizes[members].max()) // 2) // UNIT))
        padded = np.zeros((units + 2 * wide + n, MARKS), np.uint64)
        padded[wide : wide + units] = own
        around = padded[at].copy()
        for shift in range(1, n + 2 * wide):
            around |= padded[at + shift]
        lacking = np.bitwise_count(items.marks[members[item]] & ~around[place]).sum(axis=1, dtype=np.int64)
        size = items.sizes[members[item]]
        enough = size - lacking >= share * size
        place, item = place[enough], item[enough]
        if len(place) == 0:
            continue
        value, place = similar[place, item], at[place]
        order = np.lexsort((place, item, text[place]))
        place, item, value = place[order], item[order], value[order]
        apart = np.ones(len(place), bool)
        apart[1:] = (item[1:] != item[:-1]) | (text[place[1:]] != text[place[:-1]]) | (np.diff(place) > n)
        head = np.flatnonzero(apart)
        tail = np.append(head[1:], len(place)) - 1
        best = np.maximum.reduceat(value, head)
        for a, b, v in zip(head, tail, best, strict=True):
            t, i = int(text[place[a]]), int(members[item[a]])
            pad = max(UNIT, len(items.words[i]) // 2)
            low = max(int(first[t]), int(start[place[a]]) - pad)
            high = min(int(first[t + 1]), int(start[place[b]]) + n * UNIT + pad)
            yield t, i, low, high, float(v)


def _found(space: np.ndarray, items: Items, column: pa.Array, cosine: float, verbatim: float, paraphrase: float):
    """(row, item, words found, cosine) of all leaks of a column; of several in one row the longest."""
    for i, _, h, first in _words(column):
        best = {(t + i, item): (len(items.words[item]), 1.0) for t, item in _runs(items, h, first)}
        for t, item, low, high, value in _candidates(space, items, h, first, cosine, min(verbatim, paraphrase)):
            # Distinct words that do not occur here are missing from any common subsequence.
            absent = len(items.sets[item].difference(h[low:high].tolist()))
            if len(items.words[item]) - absent < min(verbatim, paraphrase) * len(items.words[item]):
                continue
            n = _leak(items.words[item], items.answers[item], h[low:high], verbatim, paraphrase)
            if n:
                best[t + i, item] = max(best.get((t + i, item), (0, 0.0)), (n, value))
        for (row, item), (n, value) in sorted(best.items()):
            yield row, item, n, value


def _query_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int | None, str | None]]]:
    rows: list[tuple[int | None, str | None]] = []
    size = 0
    for r in benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).distinct().toLocalIterator():
        rows.append((r["i"], r["t"]))
        size += len(r["t"] or "") + 16
        if size >= QUERY_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


_LEAK = "doc_id long, item_id long, n_item_words long, n_common long, cosine double"


def leaks(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", cosine: float = COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE,
) -> DataFrame:
    """(doc_id, item_id, n_item_words, n_common, cosine) of every document and item that leaks in it."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], _LEAK)
    space = latent_space(docs, text)
    if space is None:
        return empty
    wanted = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = []
    for rows in _query_blocks(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast((space, _prepared(rows, space)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            space, items = shared.value
            for batch in batches:
                found = list(_found(space, items, batch.column(1), cosine, verbatim, paraphrase))
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([items.ids[f[1]] for f in found], pa.int64()),
                        pa.array([len(items.words[f[1]]) for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.int64()),
                        pa.array([f[3] for f in found], pa.float64()),
                    ],
                    ["doc_id", "item_id", "n_item_words", "n_common", "cosine"],
                )

        out.append(wanted.mapInArrow(run, _LEAK))
    result = empty
    for part in out:
        result = part if result is empty else result.unionByName(part)
    return result


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    cosine: float = COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE,
) -> DataFrame:
    """The documents in which no item leaks, with all their columns; no shuffle of the texts."""
    space = latent_space(docs, text)
    if space is None:
        return docs
    at, schema = docs.columns.index(text), docs.schema
    for rows in _query_blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast((space, _prepared(rows, space)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            space, items = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for row, *_ in _found(space, items, batch.column(at), cosine, verbatim, paraphrase):
                    clean[row] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
