"""Connected components of a link table, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)``: the smallest node that each linked node reaches; nodes without a link are left out.

    Every round replaces the links of a node by links to the smallest node it knows, first for its larger neighbours
    and then for its smaller ones. The number of links never grows and paths shrink by half, so rounds are logarithmic
    in the longest path. A node with very many links is a minimum with map-side combining and a join whose large side
    adaptive execution can split; each round ends in a table in the shared folder.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = stage(links.where(F.col(a) != F.col(b)).select(high.alias("v"), low.alias("m")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("v", "low").alias("low"))
        large = both.where("m > v").join(least, "v").select(F.col("m").alias("v"), F.col("low").alias("m"))
        large = stage(large.distinct(), "links")
        least = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("low").alias("m")), F.struct("v", F.col("low").alias("m")))).alias("e"))
        edges = stage(small.select("e.*").where("v != m").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("m").alias("node"), F.col("m").alias("label"))
    return edges.select(F.col("v").alias("node"), F.col("m").alias("label")).unionByName(roots).distinct()
