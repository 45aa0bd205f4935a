"""Stupid-backoff scores of all documents under an n-gram model of the whole corpus, bigrams by default.

A block of documents sends its distinct n-grams with their counts to the buckets of the count table,
which is partitioned by the hash of the n-gram; each bucket adds up and hands every block its totals, in the order in
which the block named them; the block sums the scores of its documents.  So an n-gram crosses the network once per
block however often it occurs, and the commonest word is no hot key.

A word scores count(context, word) / count(context) with the longest context, of ``order`` - 1 words at most, after which
it occurs ``least`` times or more in the corpus, else count(word) / words in the corpus; each word by which the context
is shorter than the text allows costs a factor ``alpha``.  The first word of a document has no context.

Defined results: a null text or one without words scores null; repeated rows count each; a null id is kept; an
empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm import blocks as rounds
from arrearium.llm.common import as_id, chunks, mix, stored, texts_of, words_of

#: Words of the longest n-gram; the query and its SQL have a bigram model.
ALPHA, LEAST, ORDER = 0.4, 2, 2
#: Bytes of text in a block: its distinct n-grams are in memory at once.
BLOCK_BYTES = 16_000_000

_U = np.uint64


def _grams(table: pa.Table, order: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, int]]:
    """(n-grams of 1 to ``order`` words by their last word, first word of each text, texts) of ranges of a block's texts.

    A place with fewer words before it in its text holds 0.
    """
    data, offsets = texts_of(table.column("text"))
    for i, j in chunks(offsets):
        words = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        grams, before = [words.hash | _U(1)], words.hash
        for _ in range(1, order):
            longer = np.zeros(len(before), np.uint64)
            if len(before) > 1:
                gram = mix(before[:-1] * _U(0x9E3779B97F4A7C15) + mix(words.hash[1:])) & ~_U(1)
                whole = (words.text[1:] == words.text[:-1]) & (grams[-1][:-1] != 0)
                longer[1:] = np.where(whole, gram, 0)
            grams.append(longer)
            before = longer
        yield grams, words.first, j - i


def _distinct(table: pa.Table, buckets: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of a block, their counts and buckets, by bucket and then by hash."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []

    def merge() -> tuple[np.ndarray, np.ndarray]:
        # Ranges are merged as they come, so only distinct n-grams pile up.
        new, n = np.unique(np.concatenate(waiting), return_counts=True)
        all_keys, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return all_keys, np.bincount(place, np.concatenate([counts, n]), len(all_keys)).astype(np.int64)

    for grams, _, _ in _grams(table, order):
        waiting += [grams[0], *(g[g != 0] for g in grams[1:])]
        if sum(map(len, waiting)) > 1_500_000:
            keys, counts = merge()
            waiting = []
    if waiting:
        keys, counts = merge()
    bucket = ((keys >> _U(32)) % _U(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    return keys[by], counts[by], bucket[by]


def _parts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        if high > low:
            yield int(bucket[low]), low, high


def _send(buckets: int, order: int):
    def make(table: pa.Table) -> Iterable[tuple[int, bytes]]:
        keys, counts, bucket = _distinct(table, buckets, order)
        for b, low, high in _parts(bucket):
            yield b, keys[low:high].tobytes() + counts[low:high].astype("<u4").tobytes()

    return make


def _totals(table: pa.Table) -> pa.Table:
    """A bucket's count table, handed to each block in the block's own order."""
    keys, counts = [], []
    for d in table.column("data").to_pylist():
        n = len(d) // 12
        keys.append(np.frombuffer(d, "<u8", n))
        counts.append(np.frombuffer(d, "<u4", n, 8 * n))
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts)).astype("<u8")[place]
    parts = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table(
        {
            "block": table.column("block"),
            "kind": table.column("bucket"),  # an answer's kind is the bucket it comes from
            "data": pa.array([p.tobytes() for p in parts], pa.binary()),
        }
    )


_SCORE = pa.schema(
    [("id", pa.int64()), ("n_words", pa.int64()), ("n_plain", pa.int64()), ("n_backoff", pa.int64()), ("part", pa.float64())]
)


def _scores(buckets: int, order: int, least: int, alpha: float):
    def make(table: pa.Table, answers: dict[int, list[bytes]]) -> pa.Table:
        keys, _, bucket = _distinct(table, buckets, order)
        total = np.zeros(len(keys), np.int64)
        for b, low, high in _parts(bucket):
            total[low:high] = np.frombuffer(answers[b][0], "<u8")
        by = np.argsort(keys)
        keys, total = keys[by], total[by]
        out: list[list[np.ndarray]] = [[], [], [], []]
        for grams, first, texts in _grams(table, order):
            before = total[np.searchsorted(keys, grams[0])].astype(np.float64)
            with np.errstate(divide="ignore"):
                log = np.log10(before)
            used, most = np.ones(len(log), np.int64), np.ones(len(log), np.int64)
            for k in range(2, order + 1):
                has = grams[k - 1] != 0
                count = np.zeros(len(log))
                count[has] = total[np.searchsorted(keys, grams[k - 1][has])]
                seen = has & (count >= least)
                context = np.append(1.0, before[:-1])[: len(log)]
                log[seen] = np.log10(count[seen] / context[seen])
                used[seen] = k
                most += has
                before = count
            log += (most - used) * np.log10(alpha)
            sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[first])
            out[0].append(np.diff(first))
            out[1].append(sums(used == 1))
            out[2].append(sums(used < most))
            # A text's own words are added up by themselves, so a long range costs no digits.
            part = np.zeros(texts)
            some = np.flatnonzero(np.diff(first))
            if len(some):
                part[some] = np.add.reduceat(log, first[some])
            out[3].append(part)
        columns = [table.column("id").combine_chunks(), *(pa.array(np.concatenate(x)) for x in out)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, _SCORE, strict=True)], schema=_SCORE)

    return make


def scores(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, alpha: float = ALPHA,
    block_bytes: int = BLOCK_BYTES, order: int = ORDER,
) -> DataFrame:
    """(doc_id, n_words, n_backoff, log_score, mean_log_score), logarithms to the base 10."""
    own, n = rounds.in_blocks(docs, id, text, block_bytes)
    totals = rounds.send(own, _send(n, order)).groupBy("bucket").applyInArrow(_totals, rounds.ANSWER)
    schema = "id long, n_words long, n_plain long, n_backoff long, part double"
    parts = stored(rounds.finish(own, totals, _scores(n, order, least, alpha), schema, _SCORE), "scores")
    # One number, the words of the corpus, completes what was scored without a pair.
    words = parts.agg(F.sum("n_words")).first()[0] or 1
    score = F.when(F.col("n_words") > 0, F.col("part") - F.col("n_plain") * F.log10(F.lit(float(words))))
    return parts.select(
        as_id(F.col("id")).alias("doc_id"), "n_words", "n_backoff", score.alias("log_score"),
        (score / F.when(F.col("n_words") > 0, F.col("n_words"))).alias("mean_log_score"),
    )
