"""Connected components by alternating star contractions on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import join_groups, stage


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg")).withColumn(
        "m", F.least("u", "m"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; root is the least node of its component.

    Large-star then small-star until the edge table stops changing; each round is
    written to the shared folder.  Minima are partial aggregates, and rows of a
    node with very many neighbours meet its minimum by broadcast
    (``join_groups``).  Nulls are not nodes; loops and repeated edges are harmless;
    no edges give an empty result.
    """
    e = stage(edges.filter("u is not null and v is not null and u <> v")
              .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = stage(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
        mins = stage(_minima(both), "minima")
        large = stage(join_groups(both, mins, ["u"], "deg").filter("v > u")
                      .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "edges")
        mins = stage(_minima(large), "minima")
        small = join_groups(large, mins, ["u"], "deg")
        e = stage(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(mins.filter("u <> m").select("u", F.col("m").alias("v")))
                  .distinct(), "edges")
    else:
        raise RuntimeError("components did not converge")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
