"""Connected components of an edge table, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge between two different
    nodes; the component is its smallest node. Null ends are left out,
    repeated and reversed edges count once.

    Each round links every node's larger neighbours, then its smaller ones,
    to the smallest node around it; rounds are logarithmic in practice. The
    smallest neighbour comes from an aggregation that combines on the map
    side and joins back, so a node of very many edges is never gathered.
    """
    edges = edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = stored(small.where("u <> v").distinct(), "small-star")
        # a forest of stars: no centre is the end of another edge
        if new.select("v").distinct().join(new.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            if new.groupBy("u").count().where("count > 1").isEmpty():
                break
        edges = new
    return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
