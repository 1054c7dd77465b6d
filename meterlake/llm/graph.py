"""Connected components of link tables, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import kept


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node that can be reached. Nodes without links are not in the result.

    Rounds of two steps until all links form stars: every node's larger neighbours move to its smallest neighbour, then its smaller
    neighbours do. Chains shrink by at least half in a round; stars, the usual case, end after one. Every step is a join and a minimum
    with partial sums, so a node with very many links is not gathered anywhere.
    """
    edges = kept(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct())
    while True:
        both = edges.select("x", "y").unionAll(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        near = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")).withColumnRenamed("x", "y")
        large = kept(edges.join(near, "y").select("x", F.col("m").alias("y")).distinct())
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = kept(small.unionAll(low.select("x", F.col("m").alias("y"))).distinct())
        ends = edges.select(F.col("x").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select(F.col("y").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or up > 0 and down > 0").isEmpty():
            roots = edges.select("y").distinct()
            return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).unionAll(roots.select(F.col("y").alias("node"), F.col("y").alias("root")))
