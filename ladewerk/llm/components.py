"""Connected components by alternating star contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import drop_folder, new_folder, released, stored


def _star(pairs: DataFrame, up: bool) -> DataFrame:
    """One contraction of pairs (u, v): each node's smallest neighbour takes over its larger
    neighbours (up), or its smaller ones and the node itself."""
    if up:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = both.join(least, "u")
    if up:
        moved = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b); the component is its smallest node.

    Every round is two joins on the node; it ends when the edges stay as they are, each
    then leading from a node to its component. The rounds are few (the logarithm of the
    longest path), and each is written to the shared folder, from which the one before it
    is then deleted. No edges give no rows.
    """
    spark = edges.sparkSession
    folder, turn = new_folder(spark, "components"), 0
    now = stored(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), f"{folder}/0")
    state = None
    while True:
        now = stored(_star(_star(now, up=True), up=False), f"{folder}/{turn + 1}")
        drop_folder(spark, f"{folder}/{turn}")
        turn += 1
        with released(spark):
            seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
