"""Quality rules, scores, tokens, leaks, archives and shards against plain versions and libraries."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from arrearium.llm import backoff, bpe, decontaminate, quality_rules, sharding, token_counts, warc
from catalog.compare import differences, duck
from tests.llm.data import none, odd, odd_rows, prose, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("name", ["op3_warc", "op6_rules", "op7_backoff"])
def test_sql(spark, name):
    from arrearium.llm import queries

    assert differences(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.ORACLES[name]) == []


# Quality rules


def test_counts_of_odd_rows(spark):
    got = sorted(quality_rules.judged(odd(spark)).collect(), key=str)
    assert len(got) == len(odd_rows())
    for r in got:
        if r.doc_id in (4, 5, 6, 7):
            assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (0, 0, 0, 0, True)
        if r.doc_id == 10:
            assert (r.n_words, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (160, 79, 160, True)
        if r.doc_id == 12:
            assert (r.n_words, r.word_chars, r.n_symbols) == (6, 20, 3)
    assert quality_rules.judged(none(spark)).count() == 0
    kept = quality_rules.keep_good(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == sum(r.kept for r in got)
    assert quality_rules.keep_good(none(spark)).count() == 0


def test_a_bad_host_takes_its_documents_along(spark):
    rows = [(i, prose(i, 40), f"h{i % 20}") for i in range(400)]
    rows += [(1000 + i, "few words" if i % 10 else prose(i, 40), "bad") for i in range(100)]
    got = quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    lost = got.where("NOT kept").groupBy("host").count().collect()
    assert [(r["host"], r["count"]) for r in lost] == [("bad", 100)]


# Shards


@pytest.mark.parametrize("piece_rows", [30, 50_000])
def test_shards_are_exact_and_gapless(spark, documents, piece_rows):
    df = sharding.digest(documents.repartition(6))
    got = sharding.shuffled(df, 13, piece_rows=piece_rows).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(map(tuple, df.collect()))
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(13)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))


def test_matrix_follows_the_hypergeometric_law(spark):
    """Mean and variance of one cell over many draws, and exact margins."""
    parts = spark.createDataFrame([(0, 30), (1, 50), (2, 20)], "part long, n long")
    cells = []
    for seed in range(60):
        take = {r.part: r["take"] for r in sharding.communication_matrix(parts, 4, seed).collect()}
        assert [sum(take[p]) for p in range(3)] == [30, 50, 20]
        assert [sum(take[p][j] for p in range(3)) for j in range(4)] == [25] * 4
        cells += take[1]
    mean = sum(cells) / len(cells)
    spread = sum((c - mean) ** 2 for c in cells) / len(cells)
    assert abs(mean - 12.5) < 1e-9
    assert abs(spread - 25 * 0.5 * 0.5 * 75 / 99) < 1.6


def test_shards_of_odd_rows(spark):
    got = sharding.shuffled(sharding.digest(odd(spark)), 5).collect()
    assert len(got) == len(odd_rows())
    assert {r.size for r in got if r.doc_id in (4, 5, 6)} == {16} and {r.text_crc32 for r in got if r.doc_id == 4} == {0}
    assert sharding.shuffled(sharding.digest(none(spark)), 5).count() == 0


def test_shards_with_clashing_columns(spark):
    """Own columns with the names of the result and of every helper column are carried through."""
    names = ["shard", "slot", "task_", "rank_", "key_", "limits_", "piece_", "run_", "at_", "part_", "base_", "row", "n_", "take", "node", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(i, None if i % 7 == 0 else "t" * i, *(i + k for k in range(len(names)))) for i in range(200)]
    out = sharding.written(spark.createDataFrame(rows, schema).repartition(3), 6, piece_rows=20)
    assert out.columns == ["doc_id", "text", "own_shard", "own_slot", *names[2:], "shard", "slot"]
    got = out.collect()
    assert sorted(tuple(r)[:-2] for r in got) == sorted(rows)
    places = Counter((r[-2], r[-1]) for r in got)
    assert set(places.values()) == {1} and {s for s, _ in places} == set(range(6))
    whole = sharding.written(odd(spark), 4)
    assert whole.columns == [*odd(spark).columns, "shard", "slot"] and whole.count() == len(odd_rows())
    assert sharding.written(none(spark), 3).count() == 0


def test_the_query_shuffles_and_writes_whole_documents(spark, documents, monkeypatch):
    from arrearium.llm import queries

    given, real = [], sharding.shuffled
    monkeypatch.setattr(sharding, "shuffled", lambda rows, *a: given.append(rows.columns) or real(rows, *a))
    got = queries.QUERIES["op8_shards"](spark, FOLDER)
    assert given == [documents.columns]
    plain = sorted(map(tuple, sharding.digest(documents).collect()))
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got.collect()) == plain
    files = sharding.written(documents, 3)
    assert sorted(map(tuple, files.select(*documents.columns).collect()), key=str) == sorted(map(tuple, documents.collect()), key=str)
    at = {}
    for r in files.select("shard", "slot", F.input_file_name().alias("file")).collect():
        at.setdefault((r.shard, r.file), []).append(r.slot)
    assert all(slots == sorted(slots) for slots in at.values())


# Tokens


def _texts():
    r = random.Random(4)
    some = [t for _, t, *_ in odd_rows()]
    some += ["a  b", " x\n y", "it's I'll don't  \x1c a", "ab" * 3000, "tab\t x", "\x85 　wide", "end "]
    some += ["".join(r.choice("aeinorst é\n.,01'\t ") for _ in range(r.randint(1, 300))) for _ in range(300)]
    return some


def test_codec_equals_the_library():
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in filter(None, _texts()):
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    assert codec.decode(codec.encode("ab " * 9000)) == b"ab " * 9000


def test_counts_equal_the_library(spark, documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    file, library = token_counts.content(spark, path), Tokenizer.from_file(path)
    counter = token_counts.Counter(file, public_tokenizers.PATTERN)
    for text in filter(None, _texts()):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(documents, file).collect()}
    assert got == {
        r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in documents.collect()
    }
    odd_counts = token_counts.token_counts(odd(spark), file).collect()
    assert {(r.n_bytes, r.n_tokens, r.over_limit) for r in odd_counts if r.doc_id in (4, 5)} == {(0, 0, False)}
    assert len(odd_counts) == len(odd_rows()) and token_counts.token_counts(none(spark), file).count() == 0


def test_round_trip_query(spark, documents):
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = documents.select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    got = sorted(map(str, bpe.round_trip(rows, ranks).collect()))

    def row(r):
        ids = library.encode_ordinary(r.text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())

    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(
        "Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, row(r), strict=True)) + ")" for r in rows.collect()
    )
    back = bpe.decoded(bpe.encoded(rows.where("doc_id < 50"), ranks), ranks).collect()
    texts = Counter((r.text or "").encode() for r in rows.where("doc_id < 50").collect())
    assert Counter(bytes(r.data) for r in back) == texts
    assert bpe.round_trip(none(spark), ranks).count() == 0


# Scores


def test_scores_of_odd_rows(spark):
    got = backoff.scores(odd(spark), block_bytes=3000).collect()
    texts = [t for _, t, *_ in odd_rows()]
    one, two = Counter(), Counter()
    for t in texts:
        w = words(t)
        one.update(w)
        two.update(zip(w, w[1:], strict=False))
    total = sum(one.values())

    def score(t):
        w, s = words(t), 0.0
        for i, x in enumerate(w):
            pair = two[w[i - 1], x] if i else 0
            s += math.log10(pair / one[w[i - 1]] if pair >= 2 else (0.4 if i else 1) * one[x] / total)
        return round(s, 6) if w else None

    plain = Counter((i, score(t)) for i, t, *_ in odd_rows())
    assert Counter((r.doc_id, None if r.log_score is None else round(r.log_score, 6)) for r in got) == plain
    assert backoff.scores(none(spark)).count() == 0


def test_scores_back_off_again_and_again(spark):
    """Orders 3 and 4 against plain counts; few words, so that all steps occur."""
    r = random.Random(8)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 25))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    grams = Counter()
    for t in texts:
        w = t.split()
        grams.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    total = sum(n for g, n in grams.items() if len(g) == 1)

    def word(w, i, order):
        for steps, k in enumerate(range(min(order, i + 1), 0, -1)):
            g = tuple(w[i + 1 - k : i + 1])
            if k == 1 or grams[g] >= 2:
                return steps, 0.4**steps * grams[g] / (grams[g[:-1]] if k > 1 else total)

    for order in (3, 4):
        for x in backoff.scores(df, block_bytes=300, order=order).collect():
            plain = [word(texts[x.doc_id].split(), i, order) for i in range(x.n_words)]
            assert x.n_backoff == sum(steps > 0 for steps, _ in plain)
            assert plain == [] or abs(x.log_score - sum(math.log10(p) for _, p in plain)) < 1e-6


# Leaks


def test_leaks_are_found_and_clean_documents_left_alone(spark, documents):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in benchmark.collect()}
    true = set()
    for r in documents.collect():
        text = " " + " ".join(words(r.text)) + " "
        true |= {(r.doc_id, i) for i, w in items.items() if f" {' '.join(w)} " in text}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, benchmark).collect()}
    assert true and true == got
    kept = decontaminate.without_leaks(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in documents.collect()} - {d for d, _ in true}


def test_paraphrases_need_the_answer(spark):
    item = prose(40, 30) + ". the answer is clearly norweble tionanst."
    w = item.split(" ")
    changed = [x if i % 4 != 1 or i >= 30 else f"other{i}" for i, x in enumerate(w)]
    rows = [(i, prose(100 + i, 300)) for i in range(60)]
    rows += [(100, prose(50, 90) + " " + " ".join(changed) + " " + prose(51, 60))]
    rows += [(101, prose(52, 90) + " " + item.upper().replace(".", " !") + " " + prose(53, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == {(100, 7), (101, 7)}


def test_leaks_of_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, odd_rows()[0][1]), (None, None), (2, "one two")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd(spark), benchmark).collect()}
    assert {(1, 1), (2, 1), (3, 1), (8, 2)} <= got
    assert decontaminate.leaks(none(spark), benchmark).count() == 0
    empty = benchmark.where("item_id > 5")
    assert decontaminate.leaks(odd(spark), empty).count() == 0
    assert decontaminate.without_leaks(odd(spark), empty).count() == len(odd_rows())


def test_short_items_are_found_wherever_they_occur(spark):
    """Items of 1 to 7 words, verbatim in 400 other words; two equal items, and runs that only look alike."""
    rows, items, want = [], [], set()
    for n in range(1, 8):
        for k in range(15):
            item = " ".join(f"q{n}x{k}w{j}" for j in range(n))
            items.append((100 * n + k, item + "."))
            rows.append((1000 * n + k, prose(n * 50 + k, 200) + " " + item.upper() + ", " + prose(n * 70 + k, 200)))
            want.add((1000 * n + k, 100 * n + k))
    items += [(9000, "q7x0w0 q7x0w1"), (9001, "q7x0w0 q7x0w1"), (9002, "q7x0w0 q7x0w2"), (9003, "q7x0w6 q7x1w0")]
    want |= {(7000, 9000), (7000, 9001)}
    rows += [(1, "q7x0w6"), (2, "q7x1w0"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.n_common == r.n_item_words for r in found)


@pytest.mark.parametrize("kept", [0.9, 0.8, 0.7, 0.6, 0.55])
def test_recall_of_paraphrases_with_their_answer(spark, kept):
    """Of 60 items a share of the words stays in place, and the answer whole; below 0.75 only the answer decides."""
    r, rows, items = random.Random(int(100 * kept)), [], []
    for k in range(60):
        body, answer = prose(3000 + k, 40).split(" "), prose(4000 + k, 5)
        items.append((k, " ".join(body) + ". " + answer + "."))
        # The answer's five words stay, so the share of all 45 words is ``kept``.
        gone = set(r.sample(range(40), round(45 * (1 - kept))))
        said = [prose(50_000 + 100 * k + i, 1) if i in gone else w for i, w in enumerate(body)]
        rows.append((k, " ".join([prose(5500 + k, 150), *said, answer, prose(6500 + k, 150)])))
        rows.append((1000 + k, " ".join([prose(5500 + k, 150), *said, prose(7500 + k, 150)]) if kept < 0.7 else prose(7700 + k, 300)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(x.doc_id, x.item_id) for x in found}
    assert len(got & {(k, k) for k in range(60)}) >= 54
    assert not any(d >= 1000 or d != i for d, i in got)


# Archives


def test_archive_of_odd_pages(spark):
    big = "z" * 1500
    rows = [
        (1, "u1", big), (2, None, big), (2, "u2\r\nx", big), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
        (None, "u", big), (6, "u", "é" * 600),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write(pages, warc.archive_folder(spark))
    got = warc.read_all(manifest).collect()
    kinds = Counter((r.record_id, r.record_type, r.refers_to) for r in got)
    assert kinds == Counter(
        [(2, "response", None), (2, "revisit", 2), (1, "revisit", 2), (None, "revisit", 2), (3, "response", None)]
        + [(4, "response", None), (5, "response", None), (6, "response", None)]
    )
    assert all(r.payload_bytes == 1500 for r in got if r.record_id in (None, 1, 2))
    assert {r.payload_digest for r in got if r.record_id == 5} == {hashlib.sha1(b"").hexdigest()}
    found = warc.lookup(manifest, spark.createDataFrame([(3,), (6,)], "record_id long")).collect()
    assert {(r.record_id, r.payload_bytes) for r in found} == {(3, 5), (6, 1200)}
    heads = []
    for r in manifest.select("bundle", "frame_offset", "frame_bytes").distinct().collect():
        heads += [h for _, h, _ in warc.records(warc._frame(*r))]
    own = [h["WARC-Record-ID"] for h in heads]
    assert len(set(own)) == len(rows) and all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", x) for x in own)
    assert all(h["WARC-Date"] and h["Content-Type"] for h in heads)
    (response,) = [h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response" and h["X-Row-ID"] == "2"]
    assert {h["WARC-Refers-To"] for h in heads if h["WARC-Type"] == "revisit"} == {response}
    nothing = warc.write(pages.where("page_id > 9"), warc.archive_folder(spark))
    assert warc.read_all(nothing).count() == 0


def test_bundles_are_plain_zstandard(spark, tmp_path):
    import zstandard

    bundle = warc._Bundle(str(tmp_path))
    rows = []
    for i in range(5):
        payload = bytes([65 + i]) * 400_000
        rows += bundle.add(i, warc.record(i, f"u{i}", payload, hashlib.sha1(payload).hexdigest(), None, "response"))
    rows += bundle.close()
    system, inner = fs.FileSystem.from_uri(bundle.path)
    with system.open_input_file(inner) as file:
        table = warc.read_seek_table(file)
        file.seek(0)
        with zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True) as whole:
            data = whole.read()
    assert len(table) == 2 and {(r[2], r[3]) for r in rows} == set(table)
    assert [h["WARC-Target-URI"] for _, h, _ in warc.records(data)] == [f"u{i}" for i in range(5)]


# Pipeline


def test_stages_of_the_pipeline(spark):
    docs = corpus_pipeline.read(spark, FOLDER, "documents").withColumn("row_", F.lit(1))
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, last, FOLDER), "stage")
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= last.count()
        last = kept
    tokens = corpus_pipeline.STAGES[-1][1](spark, last, FOLDER)
    assert tokens.count() == last.count()
    assert corpus_pipeline.run(spark, FOLDER).count() == tokens.count()


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd(spark), none(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, FOLDER).collect()
