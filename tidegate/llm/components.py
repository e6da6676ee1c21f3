"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import stored

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest reachable node) of every node in edges (a, b); nodes are of any ordered type.

    Alternates two local steps until nothing changes, which takes a logarithmic number of rounds: every node links its
    larger neighbours to the smallest node it knows (large star), then its smaller neighbours and itself (small star).
    Both are an aggregation, combined before its shuffle, and a join with one row per node, so a hub is no hot key:
    its edges can be split. Rounds are cut by tables in the shared folder. Edges with a null end are ignored.
    """
    star = stored(edges.where(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(ROUNDS):
        mark = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = star.select(F.col("u").alias("n"), F.col("v").alias("x")).unionByName(star.select(F.col("v").alias("n"), F.col("u").alias("x")))
        least = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.where("x > n").join(least, "n").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        star.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
