"""Conversation repair and tokenizer alignment against plain programs and the libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from arrearium.llm import alignment, conversations, queries
from arrearium.llm.token_counts import byte_symbols
from catalog.compare import differences, duck
from tests.llm.data import none, odd, odd_rows, prose

FOLDER = "/root/testdata/sf0.001"


# Conversations

STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def plain_repair(rows):
    """(cost, audit, turns) of the cheapest repair of (role, text, fault) rows, by the states of the role pattern."""
    roles = {"u": "user", "a": "assistant"}

    def close(best):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, out) in list(best.items()):
                for letter, target in STEPS[state].items():
                    if letter in roles:
                        new = (cost + 3, audit + "I", (*out, (roles[letter], "")))
                        if target not in best or new < best[target]:
                            best[target], changed = new, True
        return best

    best = close({0: (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, out) in best.items():
            ways = [(state, (cost + 4, audit + "D", out))]
            if fault not in (1, 2):
                cut = 3 if fault == 3 else 0
                for letter, target in STEPS[state].items():
                    if role[:1] == letter:
                        ways.append((target, (cost + cut, audit + "K", (*out, (role, text)))))
                    if letter in roles:
                        ways.append((target, (cost + 3 + cut, audit + "R", (*out, (roles[letter], text)))))
            for target, new in ways:
                if target not in after or new < after[target]:
                    after[target] = new
        best = close(after)
    return min(best[s] for s in (0, 3) if s in best)


@pytest.mark.parametrize("settle", [1, 5, 64])
def test_parser_finds_the_cheapest_repair(monkeypatch, settle):
    monkeypatch.setattr(conversations, "SETTLE", settle)
    r = random.Random(settle)
    pools = [["user", "assistant"], ["user", "assistant", "system"], ["system"], ["tool", "user", "assistant", "system"], ["x", " ", ""]]
    for k in range(1500):
        pool = r.choice(pools)
        n = r.randint(20, 90) if k % 20 == 0 else r.randint(0, 12)
        rows = [
            (r.choice(pool) if r.random() < 0.6 else ("user", "assistant")[i % 2], f"t{i}", r.choice([0, 0, 0, 0, 1, 2, 3]))
            for i in range(n)
        ]
        parse, found = conversations.Parse(), []
        for row in rows:
            parse.add(row[0][:1], row[0], row[2], row)
            found += parse.settled()
        found += parse.rest()
        turns = tuple((role, row[1] if row else "") for _, edit, role, row, _ in found if edit != "D")
        assert (sum(f[4] for f in found), "".join(f[1] for f in found), turns) == plain_repair(rows)


def test_parser_forgets_what_is_settled():
    """Of a long conversation with a fault in every fifth row only the last part is held."""
    r = random.Random(8)
    parse, n, held = conversations.Parse(), 0, 0
    for i in range(5000):
        role = ("user", "assistant")[i % 2] if r.random() < 0.8 else r.choice(["user", "system", "x"])
        parse.add(role[:1], role, 0, i)
        n += len(parse.settled())
        held = max(held, *(len(t[1]) for t in parse.tops.values()))
    assert n + len(parse.rest()) >= 5000 and held < 300


def plain_report(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)} of damaged (conv, turn, role, text) rows."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        by_conv[conv] += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = {}
    for conv, found in by_conv.items():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, marked, count = set(), [], Counter()
        for _, role, text in found:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        turns = {t for t, _, _ in found if t is not None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        cost, audit, repaired = plain_repair(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, count[1], count[2], count[3], illegal, cost, audit, digest)
    return out


CHATS = "conv_id long, turn long, role string, text string, conv string, step int, edit string, again int"


def chats():
    r = random.Random(3)
    texts = ["Well.", "Yes!", "No?", "cut off", "", " \t", None, "Twice.", "end.\n", "日本 🙂.", "x" * 50_000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    rows = [(r.choice([*range(60), None]), r.choice([*range(9), None]), r.choice(roles), r.choice(texts)) for _ in range(700)]
    rows += rows[:40] + [(100, None, None, None), (101, 5, "user", "Only."), *[(102, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(400)]]
    # All rows of this one are dropped.
    gone = next(i for i in range(200, 400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Gone.")]


def test_report_of_odd_conversations(spark):
    rows = chats()
    df = spark.createDataFrame([(*x, "c", 1, "e", 2) for x in rows], CHATS).repartition(5)
    got = conversations.report(conversations.edits(conversations.damaged(df), gone="gone")).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain_report(rows) and len(got) == len({x[0] for x in rows})
    assert any(r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in got)


def test_edits_give_a_legal_conversation(spark):
    df = spark.createDataFrame([(*x, "c", 1, "e", 2) for x in chats()], CHATS)
    kept = conversations.edits(df).where("edit IN ('K', 'R', 'I')").collect()
    said = defaultdict(list)
    for r in sorted(kept, key=lambda r: r.step):
        said[r.conv].append(r.role[:1])
    assert said and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in said.values())
    empty = spark.createDataFrame([], CHATS)
    assert conversations.report(conversations.edits(conversations.damaged(empty), gone="gone")).count() == 0


def test_repair_sql(spark):
    assert differences(queries.QUERIES["op12_repair"](spark, FOLDER), duck(FOLDER), queries.ORACLES["op12_repair"]) == []


# Alignment

A_FILE, B_FILE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def files():
    with open(A_FILE, encoding="utf-8") as a, open(B_FILE, "rb") as b:
        return a.read(), b.read()


def plain_alignment(texts):
    """Rows of the report from whole texts, tokens compared one by one."""
    a_tok, b_tok, symbols = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE), byte_symbols()
    a_tok.encode_special_tokens = True
    found, count = [], Counter()
    for doc, text in texts:
        groups, links, a, b = [], [], [], []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            bytes_a = [bytes(symbols[c] for c in a_tok.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b_tok.id_to_piece, b)]
            whole = (" " + text).encode()
            if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
                a, b = [], []
        if a:
            at_a, at_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
            start = (0, 0)
            for end in sorted({*at_a} & {*at_b}):
                i, j = at_a.index(end, start[0]) + 1, at_b.index(end, start[1]) + 1
                groups.append(",".join(map(str, a[start[0] : i])) + "|" + ",".join(map(str, b[start[1] : j])))
                links.append((a[i - 1], b[j - 1]))
                start = (i, j)
        count.update(links)
        found.append((doc, len(a), len(b), groups, links))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return Counter(
        (doc, a, b, len(g), len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for doc, a, b, g, x in found
    )


def aligned(spark, df, files):
    return Counter(tuple(r) for r in alignment.aligned(alignment.postings(df, *files)).collect())


def test_alignment_of_a_table(spark, files, monkeypatch):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(4)
    monkeypatch.setattr(alignment, "REMEMBERED", 500)
    want = plain_alignment([(r.doc_id, r.text) for r in df.collect()])
    assert aligned(spark, df, files) == want


def test_alignment_of_odd_rows(spark, files):
    texts = [(r[0], r[1]) for r in odd_rows()]
    texts += [
        (20, "a  b"), (21, " a"), (22, "b "), (23, "x▁y"), (24, "ﬁ① é é"), (25, "tab\t and\n line \r\n"), (26, "<s> </s> <unk> <0x41> <|endoftext|>"),
        (27, "nul\x00 \x1c sep\x1f."), (28, "　wide space "), (29, prose(9, 4000)), (30, "don't I'll 's 'S ' ''"), (31, "1234567 89,5"),
        (32, "ends\n"), (33, "ends\n x"), (34, "one ▁two three"), (35, "﻿mark"), (36, " "), (37, "é" * 40_000),
    ]
    schema = "doc_id long, text string, a int, b int, box string, at int, links int"
    df = spark.createDataFrame([(*t, 1, 2, "x", 3, 4) for t in texts], schema).repartition(3)
    assert aligned(spark, df, files) == plain_alignment(texts)
    assert aligned(spark, none(spark), files) == Counter()
    assert alignment.aligned(alignment.postings(odd(spark), *files)).count() == len(odd_rows())


def test_planes_come_back(monkeypatch):
    r = np.random.default_rng(1)
    docs = np.flatnonzero(r.random(alignment.BOX_DOCS) < 0.3).astype(np.uint16)
    packed = alignment.pack(0, docs[:50]) + alignment.pack(3, docs) + alignment.pack(4, np.arange(alignment.BOX_DOCS, dtype=np.uint16))
    (p0, d0), (p3, d3), (p4, d4) = alignment.planes(packed)
    assert (p0, p3, p4) == (0, 3, 4) and (d0 == docs[:50]).all() and (d3 == docs).all() and len(d4) == alignment.BOX_DOCS
    box = alignment.Box(7)
    links = [r.integers(0, 6, r.integers(0, 400)) << 32 | 5 for _ in range(300)]
    for x in links:
        box.add(x.astype(np.int64).tobytes(), 10)
    times = {int(p >> 32): [int((x == p).sum()) for x in links] for p in np.unique(np.concatenate(links))}
    for batch in box.postings():
        for row in batch.to_pylist():
            back = np.zeros(300, np.int64)
            for digit, at in alignment.planes(row["planes"]):
                back[at] += 1 << digit
            assert back.tolist() == times[row["a"]] and (row["docs"], row["links"]) == (int((back > 0).sum()), int(back.sum()))


def test_small_boxes_give_the_same(spark, files, monkeypatch):
    """Boxes close at their bounds, and frequent pairs become plain bitmaps; the batch runs here, as a task would."""
    tokenizers = alignment.Tokenizers(*files)
    texts = ["the cat sat on the mat"] * 30 + [prose(i, 30) for i in range(30)]
    monkeypatch.setattr(alignment, "LISTED", 3)
    whole, small = alignment.Box(0), [alignment.Box(0)]
    for _, _, _, _, links in tokenizers.aligned(texts):
        whole.add(links, 1)
        if small[-1].docs == 7:
            small.append(alignment.Box(0))
        small[-1].add(links, 1)

    def sums(boxes):
        out = Counter()
        for box in boxes:
            for row in (r for b in box.postings() for r in b.to_pylist()):
                out[row["a"], row["b"], "docs"] += row["docs"]
                out[row["a"], row["b"], "links"] += sum(len(at) << digit for digit, at in alignment.planes(row["planes"]))
        return out

    assert sums([whole]) == sums(small)
