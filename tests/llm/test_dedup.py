"""Near duplicates, repeated strings and passages against plain versions."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arrearium.llm import blocks as rounds
from arrearium.llm import chaining, common, near_dedup, suffix_dedup, wire
from tests.llm.data import none, odd, odd_rows, plain_classes, plain_removed, prose, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_signatures_estimate_the_weighted_similarity():
    r = np.random.default_rng(5)
    shingle = r.integers(1, 2**63, 40).astype(np.uint64)
    a, b = r.integers(0, 9, 40), r.integers(0, 9, 40)
    rows = [(shingle[c > 0], np.full((c > 0).sum(), i), c[c > 0]) for i, c in enumerate((a, b))]
    got = near_dedup.signatures(*(np.concatenate(x) for x in zip(*rows, strict=True)), 2, 4000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((got[0] == got[1]).mean() - true) < 0.04


@pytest.mark.parametrize("leaders", [1, 2])
def test_classes_equal_brute_force(spark, documents, leaders):
    got = {r.doc_id: r.class_id for r in near_dedup.class_of_documents(documents, leaders=leaders).collect()}
    assert got == plain_classes({r.doc_id: r.text for r in documents.collect()})


def test_a_group_of_near_copies_with_fading_similarity(spark):
    """Copies of copies: links of a chain, most pairs of which are too different."""
    r, text, rows = random.Random(2), prose(9, 150).split(" "), []
    for i in range(40):
        rows.append((i, " ".join(text)))
        text = list(text)
        for _ in range(3):
            text[r.randrange(len(text))] = f"new{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for leaders in (1, 2):
        got = {x.doc_id: x.class_id for x in near_dedup.class_of_documents(df, leaders=leaders).collect()}
        assert got == plain_classes(dict(rows))


def test_one_of_each_keeps_the_smallest_and_all_columns(spark):
    kept = near_dedup.one_of_each(odd(spark))
    assert kept.columns == odd(spark).columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "4", "5", "7", "8", "9", "None", "None", "10", "11", "12", "13"])


def test_classes_of_odd_rows(spark):
    got = sorted((str(r.doc_id), str(r.class_id)) for r in near_dedup.class_of_documents(odd(spark)).collect())
    assert len(got) == len(odd_rows())
    assert {g for g in got if g[0] in list("1234567")} == {
        ("1", "1"), ("2", "1"), ("3", "1"), ("4", "4"), ("5", "5"), ("6", "5"), ("7", "7")
    }
    assert [g for g in got if g[0] == "None"] == [("None", "None")] * 2
    assert near_dedup.class_of_documents(none(spark)).count() == 0
    assert near_dedup.one_of_each(none(spark)).count() == 0


@pytest.mark.parametrize("block_bytes", [24_000_000, 40_000])
def test_removed_strings_equal_brute_force(spark, documents, block_bytes):
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        for r in suffix_dedup.without_repeats(documents, keep_text=True, block_bytes=block_bytes).collect()
    }
    assert got == plain_removed({r.doc_id: r.text.encode() for r in documents.collect()})


def test_removed_strings_of_periodic_texts(spark):
    r = random.Random(3)
    parts = ["ab" * 60, "x" * 130, "the cat sat on the mat and looked at another cat; ", "aaaaab" * 30, "é" * 40]
    rows = [(i, "".join(r.choice(parts)[r.randint(0, 20) :][: r.randint(30, 120)] for _ in range(r.randint(0, 5)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {
        x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept))
        for x in suffix_dedup.without_repeats(df, keep_text=True, block_bytes=500).collect()
    }
    assert got == plain_removed({i: t.encode() for i, t in rows})


def test_removed_strings_of_odd_rows(spark):
    got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans) for r in suffix_dedup.without_repeats(odd(spark)).collect()}
    base = next(k for k in got if k[0] == 1)
    assert got[base] == (0, 0)
    assert got[2, base[1]] == (base[1], 1)
    assert got[4, 0] == got[5, 0] == got[6, 0] == (0, 0)
    assert got[9, 3000] == (0, 0)
    assert all(v == (0, 0) for k, v in got.items() if k[0] is None)
    assert suffix_dedup.without_repeats(none(spark)).count() == 0


def test_exact_repeats_of_51_words_are_passages(spark, documents):
    texts = {r.doc_id: words(r.text) for r in documents.collect()}
    first, need = {}, set()
    for i in sorted(texts):
        for k in range(len(texts[i]) - 50):
            if first.setdefault(tuple(texts[i][k : k + 51]), i) < i:
                need.add(i)
    found = chaining.repeated_passages(documents, block_bytes=60_000).collect()
    assert need <= {r.doc_id for r in found}
    for r in found:
        assert r.other_id < r.doc_id
        assert r.n_matched >= 0.8 * (r.end_word - r.first_word)
        shared = set(texts[r.doc_id][r.first_word : r.end_word]) & set(texts[r.other_id][r.other_first_word : r.other_end_word])
        assert shared


def test_a_fuzzy_passage_is_one_passage(spark):
    base = prose(20, 90).split(" ")
    fuzzy = list(base)
    fuzzy[30] = "other"
    fuzzy[55:57] = ["three", "words", "more"]
    rows = [
        (1, prose(21, 50) + " " + " ".join(base) + " " + prose(22, 60)),
        (2, prose(23, 70) + " " + " ".join(fuzzy) + " " + prose(24, 20)),
        (3, prose(25, 200)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    (got,) = chaining.repeated_passages(df).collect()
    assert (got.doc_id, got.other_id, got.first_word, got.end_word) == (2, 1, 70, 161)
    assert (got.other_first_word, got.other_end_word) == (50, 140)
    left = {r.doc_id: words(r.text) for r in chaining.without_passages(df).collect()}
    assert left[1] == words(rows[0][1]) and left[3] == words(rows[2][1])
    assert left[2] == words(prose(23, 70)) + words(prose(24, 20))


def test_passages_of_odd_rows(spark):
    got = {r.doc_id: r.other_id for r in chaining.repeated_passages(odd(spark)).collect()}
    assert got == {2: 1, 3: 1, 11: 1}
    cut = chaining.without_passages(odd(spark))
    assert cut.columns == odd(spark).columns
    assert cut.count() == len(odd_rows())
    assert chaining.repeated_passages(none(spark)).count() == 0
    assert chaining.without_passages(none(spark)).count() == 0


def test_a_copy_is_found_although_its_seeds_occur_first_in_pieces_elsewhere(spark):
    """Docs 1 to 3 hold 22 words of a passage of 60 each, so that no run of five words occurs first in its whole copy."""
    p = prose(60, 60).split(" ")
    pieces = {1: p[:22], 2: p[18:42], 3: p[38:], 4: p, 5: p}
    rows = [(i, " ".join([prose(70 + i, 40), *w, prose(80 + i, 30)])) for i, w in pieces.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block_bytes in (24_000_000, 600):
        got = [(r.doc_id, r.other_id, r.first_word, r.end_word) for r in chaining.repeated_passages(df, block_bytes=block_bytes).collect()]
        assert got == [(5, 4, 40, 100)]
    left = {r.doc_id: words(r.text) for r in chaining.without_passages(df).collect()}
    assert left[4] == words(rows[3][1]) and left[5] == words(prose(75, 40)) + words(prose(85, 30))


def test_passages_inside_a_chain_that_is_not_similar_as_a_whole(spark):
    """Template pages: 60 equal words, then five times 10 differing and 12 equal ones."""
    def page(i, equal, differing):
        tail = [w for k in range(5) for w in (prose(200 + 10 * i + k, differing) + " " + prose(300 + k, equal)).split(" ")]
        return prose(310 + i, 30).split(" ") + prose(320, 60).split(" ") + tail

    pages = {i: page(i, 12, 10) for i in (1, 2)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in pages.items()], "doc_id long, text string")
    (got,) = chaining.repeated_passages(df).collect()
    assert (got.doc_id, got.other_id, got.first_word) == (2, 1, 30) and got.end_word >= 90
    assert got.n_matched >= 0.8 * (got.end_word - got.first_word)


def test_segments_hold_every_long_similar_stretch():
    r = np.random.default_rng(3)
    for _ in range(60):
        step = r.integers(1, 4, (2, 120)) * (r.random((2, 120)) < 0.2) + 1
        x, y = np.cumsum(step, 1)
        need, got = set(), set()
        for i in range(len(x)):
            for j in range(i, len(x)):
                width, other = x[j] - x[i] + 1, y[j] - y[i] + 1
                if width >= 25 and j - i + 1 >= 0.8 * max(width, other) - 1e-9:
                    need |= set(range(x[i], x[j] + 1))
        for x0, x1, y0, y1, n in chaining.segments(x, y, 25, 0.8):
            assert x1 - x0 >= 25 and n >= 0.8 * max(x1 - x0, y1 - y0) - 1e-9
            got |= set(range(x0, x1))
        assert got == need


def test_a_passage_in_pieces_behind_a_long_one(spark):
    """400 equal words, 60 others, then five pieces of 18 equal words with 3 words between them on one side."""
    pieces = [prose(400 + k, 18) for k in range(5)]
    rows = [
        (1, " ".join([prose(410, 400), prose(411, 60), *pieces])),
        (2, " ".join([prose(410, 400), prose(412, 60), *(p + " " + prose(420 + k, 3) for k, p in enumerate(pieces))])),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.first_word, r.end_word, r.n_matched) for r in chaining.repeated_passages(df).collect())
    assert got == [(0, 400, 400), (460, 562, 90)]


def changed(text, share, seed):
    r = random.Random(seed)
    return [w if r.random() >= share else f"new{seed}x{k}" for k, w in enumerate(text)]


@pytest.mark.parametrize("block_bytes", [24_000_000, 3000])
def test_similar_copies_whose_seeds_occur_first_in_pieces(spark, block_bytes):
    """Docs 1 to 3 hold parts of a passage of 90 words, doc 4 all of it, doc 5 all of it with 6 words changed."""
    rows, want = [], set()
    for case in range(6):
        p = prose(900 + case, 90).split(" ")
        copy = list(p)
        for k in random.Random(case).sample(range(90), 6):
            copy[k] = f"other{k}"
        for k, w in enumerate((p[:32], p[28:62], p[58:], p, copy)):
            rows.append((10 * case + k, " ".join([prose(5000 + 10 * case + k, 40), *w, prose(6000 + 10 * case + k, 30)])))
        want.add((10 * case + 4, 10 * case + 3))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.other_id) for r in chaining.repeated_passages(df, block_bytes=block_bytes).collect()}
    assert want <= got and all(a // 10 == b // 10 for a, b in got)


@pytest.mark.parametrize("block_bytes", [24_000_000, 3000])
def test_a_holder_that_is_neither_first_nor_last_is_found(spark, block_bytes):
    """Pieces of a passage of 90 words lie in documents before and after its only earlier holder, in both."""
    rows, want = [], set()
    for case in range(6):
        p = prose(300 + case, 90).split(" ")
        copy = list(p)
        for k in random.Random(case).sample(range(90), 6):
            copy[k] = f"other{k}"
        pieces = (p[:32], p[28:62], p[58:])
        for k, w in enumerate((*pieces, p, *pieces, *pieces, copy)):
            rows.append((20 * case + k, " ".join([prose(15000 + 20 * case + k, 40), *w, prose(16000 + 20 * case + k, 30)])))
        want.add((20 * case + 10, 20 * case + 3))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.other_id) for r in chaining.repeated_passages(df, block_bytes=block_bytes).collect()}
    assert want <= got and all(a // 20 == b // 20 for a, b in got)


@pytest.mark.parametrize("block_bytes", [24_000_000, 3000])
def test_copies_of_a_holder_are_not_joined_with_each(spark, block_bytes):
    """As above, but the holder is there eight times: one of them is found, by the join the earliest."""
    p = prose(300, 90).split(" ")
    copy = list(p)
    for k in random.Random(0).sample(range(90), 6):
        copy[k] = f"other{k}"
    pieces = [" ".join([prose(15000 + k, 40), *w, prose(16000 + k, 30)]) for k, w in enumerate((p[:32], p[28:62], p[58:]))]
    holder = " ".join([prose(15100, 40), *p, prose(16100, 30)])
    texts = [*pieces, *[holder] * 8, *pieces, " ".join([prose(15200, 40), *copy, prose(16200, 30)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.other_id) for r in chaining.repeated_passages(df, block_bytes=block_bytes).collect()}
    assert len(others := [other for doc, other in got if doc == len(texts) - 1]) == 1 and 3 <= others[0] < 11


def test_the_join_of_the_rest_gets_a_row_per_link_and_document():
    """However often a document repeats a link, it is joined once; all pairs of places are matched then."""
    line = prose(7, 31) + " "
    table = pa.table({"block": [0, 0], "id": [1, 2], "text": [line * 40, prose(8, 50) + " " + line * 3], "text_hash": [11, 12]})
    wanted = chaining._links(chaining._seeds(table, [20]), chaining.LINK_MOST_THERE)[0]
    got = chaining._holders(45)(table, {6: [wanted.tobytes()]})
    seen = list(zip(got.column("key").to_pylist(), got.column("other").to_pylist(), strict=True))
    assert len(seen) == len(set(seen)) and max(map(len, got.column("y").to_pylist())) > 20
    x, y = (pa.array(a, pa.list_(pa.int64())) for a in ([[(1 << 32) + 15, (40 << 32) + 15], [(9 << 32) + 20]], [[(5 << 32) + 16], [(2 << 32) + 14, 20]]))
    want = {(1, 5), (16, 21), (40, 5), (55, 21), (9, 2), (29, 16), (9, 0), (29, 20)}
    assert {(m >> 32, m & 0xFFFFFFFF) for m in chaining._matches_of(x, y, 0, 2).tolist()} == want
    assert {(m >> 32, m & 0xFFFFFFFF) for m in chaining._matches_of(x, y, 1, 2).tolist()} == {(9, 2), (29, 16), (9, 0), (29, 20)}


def test_links_of_a_row_of_equal_words_are_few():
    """The join of the rest gets a link once, however long a word is repeated."""
    table = pa.table({"text": ["la " * 3000 + prose(5, 200)]})
    link, _, _ = chaining._links(chaining._seeds(table, [20]), chaining.LINK_MOST)
    assert 0 < len(link) < 3000


def test_a_block_looks_up_its_seeds_only(monkeypatch):
    """Units are judged by their seeds, so they are not looked up among the repeated seeds."""
    table = pa.table({"block": [0] * 40, "id": list(range(40)), "text": [prose(k // 2, 300) for k in range(40)]})
    looked, find = [], chaining.rounds.find
    monkeypatch.setattr(chaining.rounds, "find", lambda keys, key: looked.append(len(key)) or find(keys, key))
    known = np.unique(chaining._seeds(table).hash & np.uint64(0xFFFFFFFF))
    seeds = chaining._first_here(table, {1: [known.tobytes()]}, 1, 45)[0]
    n = int((seeds.size == chaining.SEED_WORDS).sum())
    assert n == len(chaining._seeds(table).hash) and len(seeds.hash) > n and sum(looked) == n


def test_passages_are_placed_in_all_texts_at_once(monkeypatch):
    texts = [f"  {prose(k, 60)}\n{prose(90 + k, 9)} " for k in range(30)]
    table, calls, split = pa.table({"text": texts}), [], chaining.words_of
    monkeypatch.setattr(chaining, "words_of", lambda *a: calls.append(1) or split(*a))
    rows = [(k, 0, low, high, 0, 0, 0) for low, high in ((3, 50), (0, 69), (60, 69)) for k in reversed(range(30))]
    for (k, _, low, high, *_), (a, b) in zip(rows, chaining._bytes_of(table, rows), strict=True):
        assert texts[k].encode()[a:b].decode().split() == texts[k].split()[low:high]
        assert high < 69 or b == len(texts[k].encode())
    assert len(calls) == 1


def test_stretches_of_many_groups_equal_those_of_each():
    r = np.random.default_rng(3)
    group, x, y = np.sort(r.integers(0, 60, 900)), r.integers(0, 120, 900), r.integers(0, 9, 900)
    y += x
    got = list(zip(*(a.tolist() for a in chaining._stretches(group, x, y)), strict=True))
    want = []
    for g in range(60):
        mine = sorted((int(d), int(a)) for a, d in zip(x[group == g], (y - x)[group == g], strict=True))
        for k, (d, a) in enumerate(mine):
            if k and mine[k - 1][0] == d and a - mine[k - 1][1] <= chaining.SEED_WORDS + chaining.WINDOW:
                want[-1][3] = a - want[-1][1] + chaining.SEED_WORDS
            else:
                want.append([g, a, a + d, chaining.SEED_WORDS])
    assert got == sorted(map(tuple, want))


def test_order_by_hash_where_ids_repeat():
    r = np.random.default_rng(4)
    for ids in (np.arange(30), np.sort(r.integers(0, 6, 30))):
        row = np.sort(r.integers(0, 30, 500))
        at = np.concatenate([np.sort(r.choice(99, n, replace=False)) for n in np.bincount(row, minlength=30)])
        seeds = chaining.Seeds(r.integers(0, 40, 500).astype(np.uint64), row, at, np.full(500, 5))
        assert (chaining._by_hash(seeds, ids[row]) == np.lexsort((at, ids[row], seeds.hash))).all()


def test_alignment_of_short_runs():
    r = random.Random(6)
    for _ in range(300):
        a, b = ([r.randrange(r.choice([2, 5, 30])) for _ in range(r.randint(1, 70))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in ((i, j) for i in range(len(a)) for j in range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert chaining._common(np.array(a, np.uint64), np.array(b, np.uint64)) == best[-1][-1]
    for equal, want in (([], (0, 0)), ([1, 1, 0, 1, 1, 1, 0, 1, 1], (6, 5)), ([0, 1, 1, 1], (4, 3)), ([0, 0, 1, 1, 1], (0, 0)), ([1, 0], (1, 1))):
        assert chaining._grown(bytes(equal)) == want


def test_one_stretch_is_aligned_as_two_are():
    r = random.Random(8)
    for _ in range(200):
        mine = np.array([r.randrange(9**9) for _ in range(r.randint(30, 120))], np.uint64)
        theirs, off = mine.copy(), r.randint(0, 20)
        theirs[r.sample(range(len(mine)), r.randint(0, 8))] = 9**10
        theirs, low, shift = theirs[off:], r.randint(off, len(mine) - 8), r.randint(0, 50)
        w = r.randint(2, len(mine) - low)
        cut = r.randint(1, w - 1)
        y = low - off + shift
        one, two = [(low, y, w)], [(low, y, cut), (low + cut, y + cut, w - cut)]
        assert chaining.aligned(one, mine, theirs, shift) == chaining.aligned(two, mine, theirs, shift)


@pytest.mark.parametrize("block_bytes", [24_000_000, 6000])
def test_drifting_copies_are_linked_step_by_step(spark, block_bytes):
    """Every copy changes 10 % of the words of the one before."""
    now, rows = prose(1234, 120).split(" "), []
    for i in range(60):
        rows.append((i, " ".join([prose(7000 + i, 30), *now, prose(8000 + i, 30)])))
        now = changed(now, 0.1, i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in chaining.repeated_passages(df, block_bytes=block_bytes).collect()}
    assert len(got) >= 0.9 * 59


def plain_similar(texts, least=45, identity=0.8):
    """Documents with a stretch that an earlier one has too, by aligning all pairs on each shared word of both."""
    out = set()
    for i in sorted(texts):
        for j in sorted(texts):
            if j >= i or i in out:
                continue
            a, b = texts[i], texts[j]
            places = {}
            for k in range(len(b) - 4):
                places.setdefault(tuple(b[k : k + 5]), []).append(k)
            for shift in {k - m for m in range(len(a) - 4) for k in places.get(tuple(a[m : m + 5]), ())}:
                same = np.array([0 <= m + shift < len(b) and a[m] == b[m + shift] for m in range(len(a))])
                run = np.convolve(same, np.ones(least), "valid") if len(a) >= least else np.zeros(0)
                if (run >= identity * least + 1).any():
                    out.add(i)
    return out


@pytest.mark.parametrize("block_bytes", [24_000_000, 20_000])
def test_recall_of_similar_passages(spark, block_bytes):
    """Passages at random places, changed at up to 12 % of the words, some in many documents, some in pieces elsewhere."""
    r = random.Random(77)
    stock = [prose(9100 + k, r.randint(60, 140)).split(" ") for k in range(12)]
    texts = {}
    for i in range(150):
        parts = [prose(9500 + i, r.randint(20, 80)).split(" ")]
        for _ in range(r.choice([0, 1, 1, 2])):
            p = r.choice(stock)
            low = r.randrange(len(p) - 20)
            p = r.choice([p, p, p[low : low + 30]])
            parts += [changed(p, r.choice([0, 0.03, 0.08, 0.12]), 100 * i), prose(9700 + i, r.randint(10, 40)).split(" ")]
        texts[i] = [w for p in parts for w in p]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    found = chaining.repeated_passages(df, block_bytes=block_bytes).collect()
    got, want = {x.doc_id for x in found}, plain_similar(texts)
    assert len(want) > 40 and len(got & want) >= 0.95 * len(want)
    for x in found:
        assert x.n_matched >= 0.8 * (x.end_word - x.first_word) and x.end_word - x.first_word >= 45


def test_tree_of_ends():
    r = random.Random(2)
    tree, own = chaining._Fenwick(37), {}
    for _ in range(3000):
        at = r.randint(1, 37)
        if at in own:
            tree.drop(at)
            del own[at]
        else:
            own[at] = (r.choice([1.0, 2.0, r.random()]), at)
            tree.put(at, own[at])
        low, high = r.randint(1, 37), r.randint(0, 37)
        assert tree.most(low, high) == max([own[k] for k in range(low, high + 1) if k in own], default=chaining._NOTHING)


def test_packed_rows_and_texts_come_back_as_they_were():
    r = np.random.default_rng(8)
    dtype = np.dtype([("s", "<u8"), ("id", "<i8"), ("at", "<u4"), ("many", "u1")])
    for n in (0, 1, 2, 5000):
        rows = np.zeros(n, dtype)
        rows["s"] = np.sort(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        rows["id"], rows["at"], rows["many"] = r.integers(-9, 2**63 - 1, n), r.integers(0, 2**32, n), r.integers(0, 2, n)
        for rising in ("", "s", "id", "at"):  # a field that does not rise comes back too
            assert (wire.unpacked(wire.packed(rows, rising), dtype, rising) == rows).all()
        first = np.zeros(n, chaining._FIRST)
        first["s"], first["id"], first["at"] = rows["s"], rows["id"], rows["at"]
        for data_of in (7, 1000):
            for b, data in rounds.by_bucket(first, chaining._bucket(first["s"], data_of), lambda part: chaining._first_packed(part, data_of)):
                assert (chaining._first_unpacked(data, b, data_of) == first[chaining._bucket(first["s"], data_of) == b]).all()
    texts = ["", "a", " éß\U0001f600 x ", prose(1, 400), "\x00\n", prose(2, 30)]
    block = [3, 1, 3, 3, 1, 2]
    rows = pa.table({"block": pa.array(block, pa.int32()), "id": range(6), "text": texts, "text_hash": [-k for k in range(6)]})
    packets = [p for p in wire.text_packets(rows.to_batches()) for p in pa.table(p).to_pylist()]
    assert [p["block"] for p in packets] == [1, 2, 3]
    for p in packets:
        got = wire.texts_in(pa.table({"block": pa.array([p["block"]] * 2, pa.int32()), "data": [p["data"]] * 2}))
        mine = [k for k in range(6) if block[k] == p["block"]] * 2
        assert got.to_pydict() == {"block": [p["block"]] * len(mine), "id": mine, "text": [texts[k] for k in mine], "text_hash": [-k for k in mine]}
    assert list(wire.text_packets(rows.slice(0, 0).to_batches())) == []


def test_passages_send_fewer_bytes_than_the_texts_have(spark, documents, monkeypatch):
    """What goes from blocks to buckets and back is packed; the texts are too."""
    sent = []
    for name in ("send", "send_knowing", "answer"):
        make = getattr(chaining.rounds, name)
        monkeypatch.setattr(chaining.rounds, name, lambda *a, make=make: sent.append(make(*a)) or sent[-1])
    texts = documents.select(F.sum(F.octet_length("text"))).first()[0]
    chaining.passages(documents, block_bytes=100_000)
    total = sum(df.select(F.sum(F.octet_length("data"))).first()[0] for df in sent)
    assert total < 0.5 * texts, total / texts


def test_near_dedup_leaves_no_table_that_nothing_reads(spark, documents, monkeypatch, tmp_path):
    """Only what its result reads is still stored when the next step begins."""
    monkeypatch.setattr(common, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{os.urandom(8).hex()}")
    kept = near_dedup.one_of_each(documents)
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"classes"}
    assert 0 < kept.count() < documents.count()
    near_dedup.class_of_documents(documents).count()
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"classes", "sketches"}
