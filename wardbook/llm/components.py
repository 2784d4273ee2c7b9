"""Connected components of links between texts, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.tables import kept_table


def components(links: DataFrame) -> DataFrame:
    """node and root, the lowest node of its component, for every linked node but the roots.

    links: columns a and b of any type that can be ordered. Each round ties the neighbours
    of a node to the lowest of them, first the higher ones, then the lower ones, until
    nothing changes; a round works on at most as many links as the one before. Lowest
    neighbours are found with partial aggregation, so a node with a third of all links is
    no one task's work. Nulls link nothing.
    """
    edges = kept_table(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
        light=True,
    )
    print_before = None
    while True:
        print_now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)
        ).first()
        if print_now == print_before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        print_before = print_now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        edges = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = kept_table(edges.where("a != b").distinct(), "large-star", light=True)
        lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
        tied = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = tied.unionByName(lowest.select("a", F.col("low").alias("b"))).where("a != b").distinct()
        edges = kept_table(edges, "small-star", light=True)
