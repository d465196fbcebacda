"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import store as st


def components(edges: DataFrame, store: str, name: str) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b bigint).

    Nodes without an edge are absent.  Every round is two joins on the edge
    table and is written to the shared folder; edges never reach the driver.
    The rounds grow with the logarithm of the longest path.
    """
    e = st.saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), store, f"{name}-e0")
    seen = None
    for i in range(1, 60):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = st.saved(small, store, f"{name}-e{i}")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not converge")
    roots = e.groupBy("u").agg(F.min("v").alias("c"))
    return roots.select(F.col("u").alias("node"), F.col("c").alias("component")).union(
        roots.select(F.col("c").alias("node"), F.col("c").alias("component")).distinct())
