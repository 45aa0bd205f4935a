"""The operators over their whole tables, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.llm import (
    alignment, backoff, bpe, chaining, conversations, decontaminate, near_dedup, quality_rules, sharding, site_style, suffix_dedup,
    token_counts, warc,
)
from arrearium.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query("op1_bagminhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.class_of_documents(read(spark, folder, "documents"))


@query("op2_chaining")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return chaining.repeated_passages(read(spark, folder, "documents"))


@query(
    "op3_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    q AS (SELECT *, CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS best FROM p)
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN best IS NOT NULL AND best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN best IS NOT NULL AND best <> page_id THEN best END AS refers_to
    FROM q
    """,
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write(read(spark, folder, "pages"), warc.archive_folder(spark))
    found = warc.read_all(manifest)
    return found.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_bpe")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(read(spark, folder, "documents"), ranks, pattern=public_tokenizers.PATTERN)


@query("op5_suffix")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup.without_repeats(read(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


OP6_COUNTS = """
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows JOIN twice USING (doc_id, win), (SELECT unnest(generate_series(0, 4)) AS k)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
own AS (
  SELECT d.doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
base AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM own),
hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM base WHERE host IS NOT NULL GROUP BY host),
fit AS (
  SELECT sum(f) / sum(n) AS mean, var_pop(f / n) AS spread, avg(1 / n) AS noise FROM hosts),
prior AS (
  SELECT mean, CASE WHEN spread - mean * (1 - mean) * noise > 0
    THEN least(1000.0, greatest(1.0, mean * (1 - mean) / (spread - mean * (1 - mean) * noise) - 1))
    ELSE 1000.0 END AS weight FROM fit),
bad AS (SELECT host FROM hosts, prior WHERE (f + mean * weight) / (n + weight) > 0.5)
"""


@query(
    "op6_rules",
    OP6_COUNTS
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host NOT IN (SELECT host FROM bad) IS NOT FALSE AS kept, host FROM base
""",
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(read(spark, folder, "documents"))


@query(
    "op7_backoff",
    """
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    t AS (
      SELECT doc_id, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS prev
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d)),
    one AS (SELECT word, count(*) AS c FROM t GROUP BY word),
    two AS (SELECT prev, word, count(*) AS c FROM t WHERE prev IS NOT NULL GROUP BY ALL),
    s AS (
      SELECT t.doc_id, t.prev, two.c AS pair,
             CASE WHEN two.c >= 2 THEN log10(two.c / p.c)
                  ELSE log10(one.c) - log10((SELECT count(*) FROM t))
                       + CASE WHEN t.prev IS NULL THEN 0 ELSE log10(0.4) END END AS x
      FROM t JOIN one USING (word) LEFT JOIN two ON two.prev = t.prev AND two.word = t.word
      LEFT JOIN one AS p ON p.word = t.prev),
    r AS (
      SELECT doc_id, count(*) AS n, count(*) FILTER (pair < 2) AS backoff, sum(x) AS x FROM s GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(backoff, 0) AS n_backoff, round(x, 4) AS log_score,
           round(x / n, 4) AS mean_log_score
    FROM d LEFT JOIN r USING (doc_id)
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    out = backoff.scores(read(spark, folder, "documents"))
    return out.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


@query("op8_shards")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    out = sharding.written(read(spark, folder, "documents"))
    return sharding.digest(out, keep=("shard", "slot")).select("*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


@query("op9_decontaminate")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op10_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    file = token_counts.content(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.token_counts(read(spark, folder, "documents"), file, pattern=public_tokenizers.PATTERN)


#: Damaged rows, their faults and counts, and the cheapest reading of every beginning of a conversation.
OP12_ROWS = """
WITH RECURSIVE crc AS (  -- the table of CRC-32
  SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), n) ORDER BY n) AS t
  FROM range(256) AS r(n)),
raw AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
coded AS (
  SELECT raw.*, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS d
  FROM raw, crc),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) WHERE d <> 0),
told AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again
  FROM rows_),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i FROM told),
faulty AS (
  SELECT *, CASE WHEN solid = '' THEN 1 WHEN again > 1 THEN 2 WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
-- The cheapest (cost, audit, turns) to read nothing, a system turn, a user turn, an assistant turn last; x is out of reach.
parse AS (
  SELECT conv_id, 0 AS i, {'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])} AS p0, {'c': 999999999, 'a': '', 'o': CAST([] AS VARCHAR[])} AS p1,
         {'c': 3, 'a': 'I', 'o': ['user:']} AS p2, {'c': 6, 'a': 'II', 'o': ['user:', 'assistant:']} AS p3
  FROM counted
  UNION ALL
  SELECT conv_id, i, q0, q1, c2, list_sort([q3, {'c': c2.c + 3, 'a': c2.a || 'I', 'o': list_append(c2.o, 'assistant:')}])[1]
  FROM (SELECT conv_id, i, q0, q1, q3, list_sort([q2] || list_transform([q0, q1, q3], lambda q:
          {'c': q.c + 3, 'a': q.a || 'I', 'o': list_append(q.o, 'user:')}))[1] AS c2
        FROM (
          SELECT p.conv_id, f.i,
                 {'c': p0.c + 4, 'a': p0.a || 'D', 'o': p0.o} AS q0,
                 list_sort([{'c': p1.c + 4, 'a': p1.a || 'D', 'o': p1.o},
                   {'c': p0.c + CASE WHEN initial <> 's' OR fault IN (1, 2) THEN 999999999 WHEN fault = 3 THEN 3 ELSE 0 END,
                    'a': p0.a || 'K', 'o': list_append(p0.o, role || ':' || text)}])[1] AS q1,
                 list_sort([{'c': p2.c + 4, 'a': p2.a || 'D', 'o': p2.o}] || list_transform([p0, p1, p3], lambda p:
                   {'c': p.c + CASE WHEN fault IN (1, 2) THEN 999999999 ELSE fault END + CASE WHEN initial = 'u' THEN 0 ELSE 3 END,
                    'a': p.a || CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END,
                    'o': list_append(p.o, CASE WHEN initial = 'u' THEN role ELSE 'user' END || ':' || text)}))[1] AS q2,
                 list_sort([{'c': p3.c + 4, 'a': p3.a || 'D', 'o': p3.o},
                   {'c': p2.c + CASE WHEN fault IN (1, 2) THEN 999999999 ELSE fault END + CASE WHEN initial = 'a' THEN 0 ELSE 3 END,
                    'a': p2.a || CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END,
                    'o': list_append(p2.o, CASE WHEN initial = 'a' THEN role ELSE 'assistant' END || ':' || text)}])[1] AS q3
          FROM parse AS p JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1))),
done AS (
  SELECT p.conv_id, list_sort([p0, p3])[1] AS best FROM parse AS p JOIN counted AS c
  ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i)
"""


@query(
    "op12_repair",
    OP12_ROWS
    + """
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done AS d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations.damaged(read(spark, folder, "conversations"))
    return conversations.report(conversations.edits(rows, gone="gone"))


@query("op11_style")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return site_style.extracted(read(spark, folder, "pages"))


@query("op13_align")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = token_counts.content(spark, public_tokenizers.path("byte_bpe_50k.json"))
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return alignment.aligned(alignment.postings(read(spark, folder, "documents"), tokenizer, model))
