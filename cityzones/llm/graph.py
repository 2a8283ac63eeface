"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouping and a join; every round is written to the shared
scratch folder, so the plan does not grow and a lost executor costs one round.
The number of rounds grows with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of the undirected ``edges``: root is the smallest node that can be reached."""
    now = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = materialize(large, "edges-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialize(small.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "edges")
        last, state = state, _state(now)
        if state == last:
            return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
