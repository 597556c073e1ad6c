"""Connected components of a distributed graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from etalage.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node of the component.

    ``links`` holds two columns of one orderable type.  Null ends and links of a node to itself are ignored.
    Each round is written to the shared folder and its predecessor is no longer needed; all smallest-neighbour
    searches combine before they shuffle, and the joins are plain ones, which Spark splits at a hot node.
    """
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = written(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "links")
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
