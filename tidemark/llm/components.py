"""Connected components of an edge list, by alternating star contractions.

Each round hangs every node below the least neighbour it knows of (large star,
then small star), so paths shorten by halves and the edges end as one star per
component.  Rounds are written tables; nothing is gathered on the driver but
two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of ``u, v`` with ``u > v``."""
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    met = around.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _mark(edges: DataFrame):
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return edges.agg(F.count(F.lit(1)), total).first()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges``; the component is its least node.

    Loops and repeated edges change nothing; an edge with a null end is none.
    No edges, no rows.
    """
    state = stage(
        edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .where(f"{a} is not null and {b} is not null and u <> v")
        .distinct(),
        "edges",
    )
    mark = _mark(state)
    for _ in range(max_rounds):
        state = stage(_stars(stage(_stars(state, True), "large"), False), "small")
        was, mark = mark, _mark(state)
        if mark == was:
            roots = state.select(F.col("v").alias("node"), F.col("v").alias("component"))
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                roots.distinct()
            )
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
