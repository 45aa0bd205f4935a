"""Tables laid out by a key once, so that later joins and groupings on it shuffle nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.session import scratch_path

#: Buckets of a small installation, and rows that a bucket of a larger one has, which a task sorts in memory.
BUCKETS, BUCKET_ROWS = 32, 1_000_000


def buckets_for(rows: int) -> int:
    """Buckets of tables of which the largest has so many rows: a power of two, the same for tables that are joined."""
    buckets = BUCKETS
    while buckets * BUCKET_ROWS < rows:
        buckets *= 2
    return buckets


def laid_out(df: DataFrame, key: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """``df`` stored in sorted buckets of ``key`` and read again; rows without the key lie in one bucket.

    One shuffle now, by the same hash that joins use: tables laid out by equal keys and bucket counts join bucket by
    bucket, and groupings that contain the key need no exchange.  A key that holds more rows than a bucket should is
    better left to a shuffled join, which splits it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "buckets")
    name = f"laid_out_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan of ``df``, as planned before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line for line in plan.split("\n"))
