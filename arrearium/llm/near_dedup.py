"""Near-duplicate documents by BagMinHash signatures of their word shingles.

A document is the multiset of its runs of five words.  Every shingle owns Poisson processes in time, one for each
interval of a dyadic division of its weight ([0, 1), [1, 2), [2, 4), ...), seeded by the shingle alone; a point has a
register and a weight, and counts in a document if its weight is below the shingle's count there.  A register keeps its
earliest point, so two documents agree in it with a probability that is exactly their weighted Jaccard similarity.
Points come in order of time, and a process ends when it is later than every register: most give one point or none.

Signatures are cut into bands; documents that share a band are candidates; candidates are verified on the exact
multiset overlap; linked documents form classes.  Large bands are not expanded into pairs: all members are
held against a few leaders, and what then is in one class needs no more pairs.  For
bands that still hold several classes, a pair of different classes is verified if the two share one of their rarest
shingles: at the similarity asked for, two documents always share one of the rarest 20 % of either, so this loses no
link, and texts that differ much from all others have no such shingle.

Defined results: equal texts are one class, texts without words too if they are equal; a null text is a class of its
own; a text of one to four words has one shingle; a null id counts as larger than all and comes back as null; rows
repeated with one id are one class; an empty table gives none; other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import as_id, chunks, forget, id_or_last, mix, shingles_of, stored, texts_of, words_of
from arrearium.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
#: 24 bands of 4 registers: a pair at similarity 0.8 shares none with probability 3e-6.
BANDS, ROWS = 24, 4
#: Leaders that all members of a band are held against.
LEADERS = 2

_U = np.uint64


def _unit(bits: np.ndarray) -> np.ndarray:
    return ((bits >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def weighted(shingle: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, text) with their counts, ordered by text."""
    order = np.lexsort((shingle, text))
    s, t = shingle[order], text[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(fresh)
    return s[at], t[at], np.diff(np.append(at, len(s)))


def signatures(shingle: np.ndarray, text: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """The earliest point of every register of every text (infinite where there is none), as times."""
    best = np.full(texts * registers, np.inf)
    if len(shingle) == 0:
        return best.reshape(texts, registers)
    seeds, owner, low, high, weight = [], [], [], [], []
    lo, hi, level = 0, 1, 0
    while True:  # the dyadic intervals that reach below some count
        at = np.flatnonzero(count > lo)
        if len(at) == 0:
            break
        seeds.append(mix(shingle[at] ^ _U((0xA0761D6478BD642F * (level + 1)) & (2**64 - 1))))
        owner.append(text[at])
        low.append(np.full(len(at), lo))
        high.append(np.full(len(at), hi))
        weight.append(count[at])
        lo, hi, level = hi, 2 * hi, level + 1
    seed, own = np.concatenate(seeds), np.concatenate(owner)
    low, high, weight = np.concatenate(low), np.concatenate(high), np.concatenate(weight)
    time = np.zeros(len(seed))
    step = 0
    while len(seed):
        step += 1
        bits = mix(seed + _U((0x9E3779B97F4A7C15 * step) & (2**64 - 1)))
        time = time - np.log(_unit(bits)) / (high - low)
        where = mix(bits + _U(0xD1B54A32D192ED03))
        register = ((where >> _U(40)) * _U(registers) >> _U(24)).astype(np.int64)
        counts = high <= weight
        part = np.flatnonzero(~counts)
        if len(part):
            level_of = low[part] + _unit(mix(where[part] + _U(0x8CB92BA72F3D8DD7))) * (high[part] - low[part])
            counts[part] = level_of < weight[part]
        slot = own * registers + register
        np.minimum.at(best, slot[counts], time[counts])
        latest = best.reshape(texts, registers).max(axis=1)
        go = np.flatnonzero(time < latest[own])
        seed, own, time = seed[go], own[go], time[go]
        low, high, weight = low[go], high[go], weight[go]
    return best.reshape(texts, registers)


def _sketches(registers: int, size: int):
    """Batches of (id, node, text) to (id, node, n, sig); sig has 16 bits of each register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column(2))
            totals, sigs = [], []
            for i, j in chunks(offsets):
                words = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                shingle, text, _ = shingles_of(words, size)
                totals.append(np.bincount(text, minlength=j - i))
                times = signatures(*weighted(shingle, text), j - i, registers)
                short = (mix(times.view(_U)) >> _U(48)).astype("<u2")
                sigs += [short[k].tobytes() if totals[-1][k] else None for k in range(j - i)]
            n = np.concatenate(totals) if totals else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sigs, pa.binary())],
                ["id", "node", "n", "sig"],
            )

    return run


def overlaps(left: pa.Array, right: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shared shingles and all shingles (as multisets) of the texts in each row."""

    def side(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = texts_of(column)
        found = []
        for i, j in chunks(offsets):
            words = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            shingle, text, _ = shingles_of(words, size)
            s, t, c = weighted(shingle, text)
            found.append((s, t + i, c))
        if not found:
            return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    (s1, t1, c1), (s2, t2, c2) = side(left), side(right)
    rows = len(left)
    s, t, c = np.concatenate([s1, s2]), np.concatenate([t1, t2]), np.concatenate([c1, c2])
    order = np.lexsort((s, t))
    s, t, c = s[order], t[order], c[order]
    same = np.flatnonzero((s[1:] == s[:-1]) & (t[1:] == t[:-1]))
    shared = np.bincount(t[same], np.minimum(c[same], c[same + 1]), rows)
    return shared, np.bincount(t, c, rows) - shared


def _verified(similarity: float, size: int):
    """Batches of (a, b, text_a, text_b) to the (a, b) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                shared, union = overlaps(part.column(2), part.column(3), size)
                links = pa.array((union > 0) & (shared >= similarity * union - 1e-9))
                yield part.select(["a", "b"]).filter(links)

    return run


def _elements(size: int):
    """Batches of (node, text) to (node, elements): each shingle as often as it occurs, the times told apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            lists = []
            for i, j in chunks(offsets):
                words = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                s, t, c = weighted(*shingles_of(words, size)[:2])
                time = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                element = mix(np.repeat(s, c) + time.astype(np.uint64) * _U(0x9E3779B97F4A7C15)).view(np.int64)
                ends = np.concatenate(([0], np.cumsum(np.bincount(np.repeat(t, c), minlength=j - i))))
                lists.append(pa.LargeListArray.from_arrays(pa.array(ends), pa.array(element)))
            found = pa.concat_arrays(lists) if lists else pa.array([], pa.large_list(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found.cast(pa.list_(pa.int64()))], ["node", "elements"])

    return run


def node_of(text: Column) -> Column:
    """128 bits that stand for a text; null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))


def classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS,
    rows: int = ROWS, size: int = SHINGLE, leaders: int = LEADERS, spent: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: (id, node, n) of all rows, and (node, first_id, label, class_id, keep) of all texts.

    ``class_id`` is the smallest id of the class; ``keep`` marks the one text of a class that has it.  What else is stored
    on the way is deleted at the end; ``spent`` gets the folder of the first table, for who needs the second only.
    """
    between: list[str] = []
    own = docs.select(id_or_last(id).alias("id"), node_of(F.col(text)).alias("node"), F.col(text).alias("text"))
    sketches = stored(
        own.mapInArrow(_sketches(bands * rows, size), "id long, node binary, n long, sig binary"), "sketches", spent
    )
    # Exact copies first: a text is one node, however many rows have it.
    known = sketches.where("node is not null")
    firsts = known.groupBy("node").agg(F.min("id").alias("first_id"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = stored(firsts, "nodes", between)

    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 2 * rows * b + 1, 2 * rows)) for b in range(bands)])
    all_members = nodes.where("sig is not null").select(F.explode(keys).alias("key"), "node", "n")
    leader = [F.min(F.struct(F.xxhash64(F.lit(i), "node").alias("h"), "node", "n")).alias(f"l{i}") for i in range(leaders)]
    shared = all_members.groupBy(F.col("key").alias("of")).agg(F.min("node").alias("low"), F.max("node").alias("high"), *leader)
    shared = shared.where("low <> high").select("of", F.array(*[f"l{i}" for i in range(leaders)]).alias("leaders"))
    members = stored(
        all_members.join(shared, all_members["key"] == shared["of"]).select("key", "node", "n", "leaders"), "members", between
    )

    wanted = members.select("node").distinct()
    candidates = own.select("node", "id", "text").join(nodes.select("node", "first_id"), "node").where("id = first_id")
    texts = stored(
        candidates.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "texts", between
    )

    def verify(pairs: DataFrame) -> DataFrame:
        """The similar ones of distinct pairs (a, b), stored."""
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return stored(both.mapInArrow(_verified(similarity, size), "a binary, b binary"), "links", between)

    def near(n: Column, m: Column) -> Column:
        return F.least(n, m) >= F.greatest(n, m) * similarity - 1e-9

    def in_order(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("node", "node_o").alias("a"), F.greatest("node", "node_o").alias("b")).distinct()

    led = members.select("node", "n", F.inline("leaders").alias("h", "node_o", "n_o"))
    tested = stored(in_order(led.where((F.col("node") != F.col("node_o")) & near(F.col("n"), F.col("n_o")))), "pairs", between)
    links = verify(tested)
    labels = components(links, spent=between)
    placed = members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    open_ = stored(_several(placed, "key").select("node", "n", "label").distinct(), "open", between)
    if not open_.isEmpty():
        pairs = in_order(_prefix_pairs(open_, texts, near, similarity, size, between))
        links = links.unionByName(verify(stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs", between)))
        labels = components(links, spent=between)

    placed = nodes.select("node", "first_id").join(labels, "node", "left")
    placed = placed.select("node", "first_id", F.coalesce("label", "node").alias("label"))
    best = placed.groupBy("label").agg(F.min(F.struct("first_id", "node")).alias("best"))
    table = placed.join(best, "label").select(
        "node", "first_id", "label", F.col("best.first_id").alias("class_id"), (F.col("best.node") == F.col("node")).alias("keep")
    )
    table = stored(table, "classes")
    forget(docs.sparkSession, between)
    return sketches.select("id", "node", "n"), table


def _several(rows: DataFrame, key: str) -> DataFrame:
    """The rows of keys that hold more than one class."""
    spread = rows.groupBy(F.col(key).alias("of")).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    spread = spread.where("low <> high").select("of")
    return rows.join(spread, rows[key] == spread["of"], "left_semi")


def _prefix_pairs(open_: DataFrame, texts: DataFrame, near, similarity: float, size: int, spent: list[str]) -> DataFrame:
    """Pairs of nodes of different classes that share one of their rarest elements (prefix filter).

    Two multisets of n and m elements with Jaccard similarity t share at least t * max(n, m); so among the
    n - ceil(t * n) + 1 first elements of either, in any order common to all, there is a shared one.  The order
    is by frequency among the open nodes; elements that no other has come first and are left out.  A pair is
    made at its first shared element only, and only if what comes from there on in both (``left``) can hold the
    t / (1 + t) * (n + m) elements that a similar pair shares.
    """
    lists = texts.join(open_.select("node"), "node", "left_semi").mapInArrow(
        _elements(size), "node binary, elements array<long>"
    )
    elements = stored(lists.select("node", F.explode("elements").alias("e")), "elements", spent)
    often = elements.groupBy(F.col("e").alias("of")).agg(F.count("*").alias("c")).where("c > 1")
    known = elements.join(often, elements["e"] == often["of"])
    ordered = known.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "e"))).alias("all"))
    first = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    length = F.greatest(F.lit(0), first - (F.col("n") - F.size("all"))).cast("int")
    prefixes = ordered.join(open_, "node").select(
        "node", "n", "label", F.transform(F.slice("all", 1, length), lambda x: x["e"]).alias("prefix"),
        (F.col("n") - F.size("all")).alias("alone"),
    )
    placed = prefixes.select("node", "n", "label", "prefix", "alone", F.posexplode("prefix").alias("pos", "e"))
    placed = placed.withColumn("left", F.col("n") - F.col("alone") - F.col("pos")).drop("alone", "pos")
    rows = stored(_several(placed, "e"), "prefixes", spent)
    # Pairs have a member outside the element's largest class, so that class is never paired with itself.
    cells = rows.groupBy("e", "label").agg(F.count("*").alias("c"))
    main = cells.groupBy(F.col("e").alias("of")).agg(F.max(F.struct("c", "label"))["label"].alias("main"))
    lone = rows.join(main, rows["e"] == main["of"]).where("label <> main")
    lone = lone.select("e", *[F.col(c).alias(f"{c}_o") for c in ("node", "n", "label", "prefix", "left")])
    at_first = F.get(F.array_intersect("prefix", "prefix_o"), F.lit(0)) == F.col("e")
    apart = (F.col("label") != F.col("label_o")) & near(F.col("n"), F.col("n_o"))
    needed = (F.col("n") + F.col("n_o")) * (similarity / (1 + similarity)) - 1e-9
    enough = F.least("left", "left_o") >= needed
    return rows.join(lone, "e").where(apart & enough & at_first)


def class_of_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, class_id, n_shingles): one row per row of ``docs``."""
    rows, table = classes(docs, id, text, **options)
    found = rows.join(table.select("node", "class_id"), "node", "left")
    return found.select(
        as_id(F.col("id")).alias("doc_id"), as_id(F.coalesce("class_id", "id")).alias("class_id"), F.col("n").alias("n_shingles")
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with one of each class, the one with the smallest id; documents with a null text stay."""
    spent: list[str] = []
    _, table = classes(docs, id, text, spent=spent, **options)
    forget(docs.sparkSession, spent)
    keep = table.where("keep").select(F.col("node").alias("node_"), F.col("first_id").alias("first_"))
    own = docs.select(F.struct("*").alias("row_"), node_of(F.col(text)).alias("n_"), id_or_last(id).alias("i_"))
    chosen = own.join(keep, (F.col("n_") == F.col("node_")) & (F.col("i_") == F.col("first_")), "left_semi")
    rows = chosen.groupBy("n_", "i_").agg(F.first("row_").alias("row_")).select("row_.*")
    return rows.unionByName(docs.where(F.col(text).isNull()))
