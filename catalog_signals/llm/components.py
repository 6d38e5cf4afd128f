"""Connected components of links between numbered nodes, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import checkpointed, straight_from_shuffle


def _stars(edges: DataFrame) -> bool:
    """Does every node that points somewhere point at one node only, which points nowhere?"""
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("out")), F.struct(F.col("v").alias("x"), F.lit(0).alias("out")))
    nodes = edges.select(F.explode(ends).alias("e")).select("e.x", "e.out").groupBy("x").agg(
        F.sum("out").alias("out"), F.min("out").alias("least")
    )
    return nodes.where("out > 1 or (out = 1 and least = 0)").isEmpty()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` (the least node it is connected with) of all nodes that have links.

    Edges go from the greater node ``u`` to the lesser ``v``. The large step points the greater
    neighbours of a node to its least neighbour, the small step the lesser ones; the number of edges
    never grows, and after about log(nodes) rounds every node points at its least, which is what ends
    the rounds. Minima are taken in every task before a shuffle, and joins can be split at a node with
    very many neighbours. Each round is checkpointed; no edge reaches the driver.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = checkpointed(edges.distinct())
    while not _stars(edges):
        ways = F.array(
            F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        both = edges.select(F.explode(ways).alias("e")).select("e.x", "e.y")
        least = both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("m"))
        large = edges.join(straight_from_shuffle(least), F.col("v") == F.col("x")).select("u", F.col("m").alias("v"))
        large = checkpointed(large)
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        turned = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(straight_from_shuffle(least), F.col("u") == F.col("x")).select(F.explode(turned).alias("e"))
        edges = checkpointed(small.select("e.u", "e.v").where("u <> v").distinct())
    pointing = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pointing.unionByName(roots)


def resolved(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``node``, ``links``, ``component``, ``first`` for every class of equal records.

    ``classes`` has ``node`` and ``first`` (what orders its records, of any type); ``found`` has
    ``node``, ``links``, ``least``, several rows per node, and is read more than once. ``first`` becomes
    the least of the component.
    """
    links = found.groupBy(F.col("node").alias("_linked")).agg(F.sum("links").alias("links"))
    components = connected_components(found, "node", "least").withColumnRenamed("node", "_member")
    joined = classes.join(links, F.col("node") == F.col("_linked"), "left").join(
        components, F.col("node") == F.col("_member"), "left"
    )
    joined = joined.select(
        "node", "first", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "node").alias("component"),
    )
    least = joined.groupBy(F.col("component").alias("_c")).agg(F.min("first").alias("_first"))
    led = joined.join(straight_from_shuffle(least), F.col("component") == F.col("_c"))
    return led.select("node", "links", "component", F.col("_first").alias("first"))
