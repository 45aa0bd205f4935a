"""Connected components of an edge table by alternating stars; every step is a grouping and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import stored


def _stars(both: DataFrame) -> DataFrame:
    """Smallest neighbour (or self) of each node, beside each of its edges."""
    least = both.groupBy(F.col("u").alias("of")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, both["u"] == least["of"])


def components(edges: DataFrame, a: str = "a", b: str = "b", spent: list[str] | None = None) -> DataFrame:
    """(node, label): the smallest node of the component, for all nodes that have an edge and aren't that node.

    Large stars hang every larger neighbour on the smallest one, small stars every smaller one; the edges never
    grow in number and end as one star per component.  Each round is stored in the shared folder (``spent``
    gets the folders).  Edges with a null end, loops and repeated edges change nothing.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges", spent
    )
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _stars(large)  # u is the larger end of every edge here
        hung = small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = stored(hung.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "edges", spent)
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state
