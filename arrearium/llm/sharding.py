"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix (built-in functions only).

Rows lie in parts (the tasks that read them).  How many rows of each part go to each shard is drawn first, from
the exact law of a uniform shuffle: the parts are halved again and again, and each half gets its share of every
shard by hypergeometric draws.  Then each part permutes its rows and sends the first to shard 0, the next to
shard 1 and so on as drawn, and each shard permutes what it got.  Shard sizes differ by one row at most.

Defined results: a null text has no bytes; repeated rows are rows of their own; an empty table gives no rows;
null ids are kept.  The result depends on the seed and on how Spark splits the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from arrearium.llm.common import stored
from arrearium.session import scratch_path

#: Rows that one task of a shard permutes at most, about.
PIECE_ROWS = 50_000
SHARDS = 40


def _hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Inversion of a uniform ``u``: how many of ``drawn`` of ``total`` are among the ``good`` ones.

    Weights are taken relative to the mode, by the ratio of neighbours, outwards until they vanish in double
    precision; so nothing overflows, and few terms are made.
    """
    ratio = lambda k: ((good - k) * (drawn - k)) / ((k + 1) * (total - good - drawn + k + 1))
    low = F.greatest(F.lit(0.0), good + drawn - total)
    high = F.least(good, drawn)
    spread = F.sqrt(drawn * (good / total) * (1 - good / total)) + 1
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1) * (good + 1) / (total + 2)).cast("double")))
    reach = (F.lit(45.0) * spread + 60).cast("int")
    steps = F.when(reach > 0, F.sequence(F.lit(0), reach)).otherwise(F.array(F.lit(0)))

    state = lambda k, w, s: F.struct(k.alias("k"), w.alias("w"), s.alias("s"))

    def up(a: Column, _: Column) -> Column:
        w = F.when(a["k"] < high, a["w"] * ratio(a["k"])).otherwise(F.lit(0.0))
        return state(a["k"] + 1, w, a["s"] + w)

    def down(a: Column, _: Column) -> Column:
        w = F.when(a["k"] > low, a["w"] / ratio(a["k"] - 1)).otherwise(F.lit(0.0))
        return state(a["k"] - 1, w, a["s"] + w)

    zero = state(mode, F.lit(1.0), F.lit(0.0))
    above = F.aggregate(steps, zero, up, lambda a: a["s"])
    below = F.aggregate(steps, zero, down, lambda a: a["s"])

    def find(totals: Column) -> Column:
        aim = u * (totals["a"] + totals["b"] + 1)

        # Mode first, then upwards, then downwards: any fixed order inverts.
        def walk(back: bool, target: Column) -> Column:
            def step(a: Column, _: Column) -> Column:
                k = a["k"] - 1 if back else a["k"] + 1
                w = F.when(a["k"] > low, a["w"] / ratio(a["k"] - 1)) if back else F.when(
                    a["k"] < high, a["w"] * ratio(a["k"])
                )
                w = w.otherwise(F.lit(0.0))
                done = (a["s"] >= target) | (w == 0)
                return state(
                    F.when(done, a["k"]).otherwise(k),
                    F.when(done, F.lit(0.0)).otherwise(w),
                    F.when(done, F.greatest(a["s"], target)).otherwise(a["s"] + w),
                )

            return F.aggregate(steps, zero, step, lambda a: a["k"])

        return (
            F.when(aim <= 1, mode)
            .when(aim <= 1 + totals["a"], walk(False, aim - 1))
            .otherwise(walk(True, aim - 1 - totals["a"]))
        )

    totals = F.struct(above.alias("a"), below.alias("b"))
    some = F.element_at(F.transform(F.array(totals), find), 1)
    return F.when(low >= high, low).otherwise(some)


def _uniform(seed: int, *keys: Column) -> Column:
    """A number above 0 and below 1 that the keys decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double")
    return (bits + 0.5) / F.lit(float(2**53))


def _left_share(room: Column, left: Column, seed: int, node: Column) -> Column:
    """Of the shards' ``room`` (array of double) under a node, the part that its left half fills: one shard after the other."""
    sum_of = F.aggregate(room, F.lit(0.0), lambda a, b: a + b)
    zero = F.struct(
        sum_of.alias("total"), left.alias("drawn"), F.lit(0).alias("j"), F.array().cast("array<double>").alias("out")
    )

    def step(a: Column, good: Column) -> Column:
        u = _uniform(seed, node, a["j"])
        inputs = F.struct(a["total"].alias("t"), good.alias("g"), a["drawn"].alias("d"), u.alias("u"))
        got = F.element_at(
            F.transform(F.array(inputs), lambda x: _hypergeometric(x["t"], x["g"], x["d"], x["u"])), 1
        )
        return F.element_at(
            F.transform(
                F.array(got),
                lambda x: F.struct(
                    (a["total"] - good).alias("total"),
                    (a["drawn"] - x).alias("drawn"),
                    (a["j"] + 1).alias("j"),
                    F.concat(a["out"], F.array(x)).alias("out"),
                ),
            ),
            1,
        )

    return F.aggregate(room, zero, step, lambda a: a["out"])


def communication_matrix(parts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, take): how many rows of each part go to each shard, drawn exactly.

    ``parts`` has (part, n) with parts 0 to P - 1.  The tree has log2 P levels; each joins the sizes of its nodes
    and splits every node's row into two, so no task sees more than its own nodes.
    """
    spark = parts.sparkSession
    rows, last = parts.agg(F.sum("n"), F.max("part")).first()
    rows, levels = rows or 0, max(0, (last or 0)).bit_length()
    room = [float(rows // shards + (1 if j < rows % shards else 0)) for j in range(shards)]
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("room", T.ArrayType(T.DoubleType()))])
    tree = spark.createDataFrame([(0, room)], schema)
    for level in range(levels):
        halves = parts.groupBy(F.shiftright("part", levels - level - 1).alias("half")).agg(F.sum("n").alias("n"))
        left = halves.where("half % 2 = 0").select(F.shiftright("half", 1).alias("of"), "n")
        split = tree.join(left, tree["node"] == left["of"], "left").select(
            "node",
            "room",
            _left_share(
                F.col("room"),
                F.coalesce(F.col("n"), F.lit(0)).cast("double"),
                seed,
                F.col("node") + F.lit(1 << level),
            ).alias("left"),
        )
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("room")),
            F.struct(
                (F.col("node") * 2 + 1).alias("node"),
                F.zip_with("room", "left", lambda a, b: a - b).alias("room"),
            ),
        )
        tree = split.select(F.inline(both))
    return tree.select(F.col("node").alias("part"), F.transform("room", lambda x: x.cast("long")).alias("take"))


def _prefix(values: Column) -> Column:
    """Running sums of an array, the first being the first value."""
    return F.aggregate(
        values,
        F.array().cast("array<long>"),
        lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x)),
    )


def shuffled(rows: DataFrame, shards: int = SHARDS, seed: int = 17, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """All rows with ``shard`` and ``slot``; own columns of these names are called ``own_shard`` and ``own_slot`` then.

    The rows are stored once with their part and a random key, so every later step sees the same draw however
    often a task runs.  Parts are cut so that none exceeds ``piece_rows`` by much; slots are dealt in pieces of a
    shard, so no task ever holds a whole shard.
    """
    # A row is carried as one value, so its columns may have any names.
    rows = rows.withColumnsRenamed({c: f"own_{c}" for c in ("shard", "slot") if c in rows.columns})
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    own, low_bits = rows.columns, F.lit((1 << 33) - 1)
    # A task's rows in runs: (task, run) is a part.  Each task permutes its runs itself, before anything is exchanged.
    drawn = rows.select("*", F.monotonically_increasing_id().alias("at_"), F.rand(seed).alias("key_")).select(
        *own, "key_", F.floor(F.col("at_").bitwiseAND(low_bits) / piece_rows).alias("run_")
    )
    permuted = drawn.sortWithinPartitions("run_", "key_", *[F.xxhash64(c) for c in own])
    staged = stored(
        permuted.select("*", F.monotonically_increasing_id().alias("at_")).select(
            *own,
            "key_",
            F.shiftright("at_", 33).alias("task_"),
            "run_",
            (F.col("at_").bitwiseAND(low_bits) - F.col("run_") * piece_rows + 1).alias("rank_"),
        ),
        "shards",
        compression="zstd",
    )
    runs = staged.groupBy("task_", "run_").agg(F.count("*").alias("n"))
    # Number the parts 0 to P - 1: the tasks' offsets are sums over tasks, a small table.
    tasks = runs.groupBy("task_").agg(F.max("run_").alias("runs"))
    before = Window.orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task_", F.coalesce(F.sum(F.col("runs") + 1).over(before), F.lit(0)).alias("base_"))
    parts = stored(
        runs.join(tasks, "task_").select("task_", "run_", (F.col("base_") + F.col("run_")).alias("part"), "n"),
        "shard-parts",
    )
    matrix = communication_matrix(parts.select("part", "n"), shards, seed)
    # Stored, so that its size is known and the rows are not exchanged for this small table.
    limits = stored(
        parts.join(matrix, "part").select("task_", "run_", _prefix(F.col("take")).alias("limits_")), "shard-limits"
    )
    sent = staged.join(limits, ["task_", "run_"]).withColumn(
        "shard", F.size(F.filter("limits_", lambda x: x < F.col("rank_"))).cast("int")
    )
    second = F.xxhash64(F.lit(seed + 1), "key_", "rank_", "task_", "run_")
    total = parts.agg(F.sum("n")).first()[0] or 0
    pieces = max(1, -(-total // (shards * piece_rows)))
    sent = sent.select(
        *own, "shard", second.alias("key_"), F.pmod(F.shiftright(second, 20), F.lit(pieces)).alias("piece_")
    )
    if pieces > 1:
        sizes = sent.groupBy("shard", "piece_").agg(F.count("*").alias("n_"))
        earlier = Window.partitionBy("shard").orderBy("piece_").rowsBetween(Window.unboundedPreceding, -1)
        bases = sizes.select("shard", "piece_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("base_"))
        sent = sent.join(bases, ["shard", "piece_"])
    else:
        sent = sent.withColumn("base_", F.lit(0))
    final = Window.partitionBy("shard", "piece_").orderBy("key_", *[F.xxhash64(c) for c in own])
    slot = (F.row_number().over(final) - 1 + F.col("base_")).cast("long").alias("slot")
    return sent.select("row", "shard", slot).select("row.*", "shard", "slot")


def written(rows: DataFrame, shards: int = SHARDS, seed: int = 17, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The shards of ``shuffled`` as files, read again: a folder a shard, whose files hold pieces of it in order of slots."""
    spark = rows.sparkSession
    out, path = shuffled(rows, shards, seed, piece_rows), scratch_path(spark, "shard-files")
    out.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path).select(*[F.col(f"`{c}`") for c in out.columns])


def digest(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Of a document its id, its size (UTF-8 bytes and 16), the CRC-32 of its text and the columns ``keep``."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(data) + 16).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        *keep,
    )
