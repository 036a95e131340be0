"""Connected components of a graph that may hold any number of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.storage import Workspace


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for each node of ``links`` (``a``,
    ``b``: longs, either way round, repeats allowed).

    Alternating large-star and small-star rounds: each node's larger neighbours are tied to its
    smallest neighbour, then its smaller ones. The rounds number as the logarithm of the longest
    path; the links of each are a table in the checkpoint folder. A node tied to very many others
    only ever carries pairs of longs: its minimum is aggregated before the shuffle, written as a
    table and joined back from there, so that the join reads nothing but two exchanges and
    adaptive execution can split such a node's rows.
    """
    work = Workspace(links.sparkSession, "components")
    edges = work.write(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    before = None
    while True:
        # Large star: neighbours above a node go to the smallest of the node and its neighbours.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = work.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = work.write(
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        # Small star: a node's neighbours below it, and the node itself, go to the smallest one.
        smallest = work.write(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(smallest, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = work.write(small.union(smallest.select("a", F.col("m").alias("b"))).distinct())
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    # Every node but the smallest of its component now points at that one.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
