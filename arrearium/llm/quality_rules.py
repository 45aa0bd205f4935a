"""Quality rules per document, and per host by shrunk failure rates (built-in functions only).

Each document is judged by itself from counts over its whole text.  Failures are then counted per host (the
column that names a document's origin); a host's rate is shrunk towards the mean of all hosts by a beta prior
whose parameters are fitted to the hosts' rates by moments; documents of a host whose shrunk rate is above
``host_limit`` are rejected with it.

Defined results: a null text has no words; a document with a null host is judged by itself alone; a host with
few documents leans on the prior; where hosts do not differ beyond chance the prior weighs ``strongest``
documents; repeated rows count each; an empty table gives none; other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import stored

#: Fixed values of the contract: white space, words, and the characters that count as symbols.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
#: A host goes when its shrunk failure rate is above this; the prior weighs this many documents at most.
HOST_LIMIT, STRONGEST = 0.5, 1000.0


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _places(w: Column, size: int) -> Column:
    """Where a window of ``size`` words begins that occurs elsewhere in the text too: windows sorted as text."""
    at = F.sequence(F.lit(0), F.size(w) - size)
    windows = F.transform(at, lambda i: F.struct(F.array_join(F.slice(w, i + 1, size), " ").alias("w"), i.alias("i")))

    def twice(o: Column) -> Column:
        def place(x: Column, k: Column) -> Column:
            before, after = F.get(o, k - 1)["w"], F.get(o, k + 1)["w"]
            return F.when(before.eqNullSafe(x["w"]) | after.eqNullSafe(x["w"]), x["i"])

        return F.sort_array(F.filter(F.transform(o, place), lambda i: i.isNotNull()))

    return _let(F.sort_array(windows), twice)


def repeated_words(w: Column, size: int = WINDOW) -> Column:
    """Words in windows of ``size`` words found twice or more.

    Window hashes that all differ settle most texts; only the others sort their windows, as text.
    """

    def total(p: Column) -> Column:
        own = F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size))))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, b: a + b)

    def count(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - size)
        hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        exact = _let(_places(w, size), total)
        return F.when(
            F.size(w) > size,
            _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), exact).otherwise(F.lit(0))),
        ).otherwise(F.lit(0))

    return _let(w, count).cast("long")


def _failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words)


def counts(text: Column) -> dict[str, Column]:
    """The counts of a text, by name."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    both = _let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    return {
        "both": both,
        "word_chars": F.length(F.translate(whole, SPACE, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def base_failed(text: Column) -> Column:
    """Whether a document fails by itself."""
    return _let(words(text), lambda w: _failed(F.size(w), repeated_words(w)))


def rejected_hosts(
    verdicts: DataFrame, host: str, failed: str, host_limit: float = HOST_LIMIT, strongest: float = STRONGEST
) -> DataFrame:
    """Hosts (column ``rejected_host``) whose shrunk failure rate is above the limit.

    Counting per host combines on the map side, so a hot host is one row per task.  The prior is two numbers,
    fitted over all hosts: the mean rate, and how many documents it weighs.
    """
    hosts = (
        verdicts.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("rejected_host"))
        .agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("fails"))
    )
    rate = F.col("fails") / F.col("n")
    fit = hosts.agg(
        (F.sum("fails") / F.sum("n")).alias("mean"),
        F.var_pop(rate).alias("spread"),
        F.avg(1 / F.col("n")).alias("noise"),
    ).first()
    mean, weight = fit["mean"] or 0.0, strongest
    beyond = (fit["spread"] or 0.0) - mean * (1 - mean) * (fit["noise"] or 0.0)
    if beyond > 0:
        weight = min(strongest, max(1.0, mean * (1 - mean) / beyond - 1))
    shrunk = (F.col("fails") + mean * weight) / (F.col("n") + weight)
    return hosts.where(shrunk > host_limit).select("rejected_host", shrunk.alias("host_rate"))


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Counts and verdicts of all documents.  Counts are made once and stored; the host join moves no text."""
    made = counts(F.col(text))
    both = made.pop("both")
    counted = docs.select(
        F.col(id).alias("doc_id"),
        F.col(host).alias("host"),
        both.alias("both"),
        *[c.alias(n) for n, c in made.items()],
    )
    n_words, n_repeat = F.col("both")["n"], F.col("both")["r"]
    own = stored(
        counted.select(
            "doc_id",
            "host",
            n_words.alias("n_words"),
            *made,
            n_repeat.alias("n_repeat_words"),
            _failed(n_words, n_repeat).alias("base_failed"),
        ),
        "quality",
    )
    bad = rejected_hosts(own, "host", "base_failed")
    return own.join(bad, own["host"] == bad["rejected_host"], "left").select(
        *[c for c in own.columns if c != "host"], (~F.col("base_failed") & F.col("rejected_host").isNull()).alias("kept"), "host"
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with all their columns.  Texts are read twice rather than shuffled."""
    failed = base_failed(F.col(text))
    # Stored, so that its size on disk decides whether it is sent to all; else the texts are dealt by host and hot hosts split.
    bad = stored(rejected_hosts(docs.select(F.col(host).alias("h"), failed.alias("f")), "h", "f"), "hosts")
    return docs.where(~failed).join(bad, docs[host] == bad["rejected_host"], "left_anti")
