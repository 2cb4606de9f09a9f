"""Connected components of a graph that is larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node of each node's component, for the nodes of undirected links: node, root.

    Large star and small star in turn (Kiveris and others, 2014): every node points its larger
    neighbours, then its smaller ones, at its smallest neighbour, until nothing moves. Each round is
    stored. Smallest neighbours are found by a combined aggregate, so a node with very many links is
    never gathered in one task; the join that hands them back is one that Spark can split.
    """
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u <> v").distinct()
    edges, before = stored(edges, "links"), None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before or not mark["n"]:
            return edges.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("node"), "root").unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        before = mark
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("of"), F.least("v", "m").alias("m"))
        large = both.join(least, F.col("v") == F.col("of")).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = stored(large, "links")
        least = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("of"), "m")
        small = large.join(least, F.col("v") == F.col("of")).where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = stored(small.unionByName(least.select(F.col("of").alias("v"), F.col("m").alias("u"))).distinct(), "links")
