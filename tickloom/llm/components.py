"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.scratch import cut, release, shuffled

MAX_ROUNDS = 40


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over rows (a, b), a > b. The minimum of each neighbourhood combines before the shuffle."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = near.join(shuffled(least), "a")
    if large:
        out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = out.filter(F.col("a") != F.col("b"))
    return out if large else out.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node it reaches. Every round is stored."""
    ab = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    state, before = cut(ab, "edges"), None
    for _ in range(MAX_ROUNDS):
        after = cut(_step(_step(state, True), False), "edges")
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        release(state)
        state = after
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    own = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
