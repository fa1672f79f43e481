"""Connected components of a graph in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b): the least node reachable, by large-star and
    small-star steps (Kiveris and others). Each step aggregates per node with partial sums, so a hub
    with very many links is joined as a skewed key and never gathered. Rounds are logarithmic in
    practice; the links after each one are a stored table."""
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    table = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    last = table.agg(*mark).first()
    while True:
        # large star: every greater neighbour of a node goes to the least of its neighbourhood
        both = table.select("a", "b").union(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # small star: the smaller neighbours of a node, and the node itself, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        table = stage(small.where("a <> b").distinct(), "stars")
        now = table.agg(*mark).first()
        if now == last:
            break
        last = now
    roots = table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return table.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
