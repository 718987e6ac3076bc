"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwave.session import stage

EDGES_PER_FILE = 1_000_000


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); the component is its smallest node.

    Large-star and small-star steps, each a join and an aggregation of the edges, repeat until the
    edges are stars: no node has two edges down, or edges both up and down. The number of repeats grows with the
    logarithm of the longest path. Minima are combined before they are shuffled, and joins on a node
    with very many edges can be split by Spark. Links of a node with itself and repeated links do no harm.
    """
    links = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    files = 1 + links.count() // EDGES_PER_FILE  # edges never get more than the links
    edges = links.where("u <> v").distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        pairs = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        edges = stage(small.select(pairs.alias("p")).select("p.*").where("u <> v").distinct().coalesce(files), "edges")
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))).alias("e")).select("e.*")
        per_node = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if not per_node.where("down > 1 or (down = 1 and up = 1)").limit(1).count():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stage(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).coalesce(files), "components")
