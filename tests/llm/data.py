"""Small documents with what goes wrong in practice, and plain versions of what the operators compute."""

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n_chars long, node string, id long, block int, label string, low long"


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    r = random.Random(seed)
    syllables = ["an", "the", "or", "ing", "tion", "re", "ed", "st", "é", "ña", "wh", "ble"]
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and white texts, ties, repeated rows, one long word, copies and near copies."""
    base = prose(1, 120).split(" ")
    near = list(base)
    near[60] = "changed"
    texts = [
        (1, " ".join(base), "a"),
        (2, " ".join(base), "a"),
        (3, " ".join(near), "b"),
        (3, " ".join(near), "b"),
        (4, None, "a"),
        (5, "", "a"),
        (6, "", None),
        (7, " \n\t ", "b"),
        (8, "one two", "b"),
        (9, "x" * 3000, "b"),
        (None, prose(2, 30), "b"),
        (None, prose(3, 30), None),
        (10, "line one\nline one\n" * 40, "c"),
        (11, prose(4, 40) + "  " + " ".join(base[10:80]) + " " + prose(5, 30), "c"),
        (12, "Tab\tand\x0bform\x0cfeed\r\nend #$%", "c"),
        (13, "日本語 テキスト 🙂 <|endoftext|> tail", "c"),
    ]
    return [(i, t, s, len(t or ""), "n", 99, 7, None, 5) for i, t, s in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, size=5):
    w = words(text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def similar(a, b, least=0.8):
    shared = sum(min(v, b[k]) for k, v in a.items())
    union = sum(a.values()) + sum(b.values()) - shared
    return union > 0 and shared >= least * union - 1e-9


def plain_classes(texts):
    """{id: smallest id of its class} by comparing all pairs."""
    ids = sorted(texts)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = {i: shingles(texts[i]) for i in ids}
    for a in ids:
        for b in ids:
            if a < b and texts[a] is not None and (texts[a] == texts[b] or (bags[a] and similar(bags[a], bags[b]))):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def plain_removed(texts, n=50):
    """{id: (bytes, removed, spans, kept)} of the rule on repeated strings."""
    first = {}
    for i in sorted(texts):
        t = texts[i]
        for k in range(len(t) - n + 1):
            first.setdefault(t[k : k + n], i)
    out = {}
    for i, t in texts.items():
        gone = bytearray(len(t))
        for k in range(len(t) - n + 1):
            if first[t[k : k + n]] < i:
                gone[k : k + n] = b"\1" * n
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out
