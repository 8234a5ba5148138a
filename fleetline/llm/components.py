"""Connected components of a link table, by alternating star contraction.

Every round rewires each node to the smallest neighbour it knows (large star,
then small star) until nothing changes: a logarithmic number of rounds in
practice.  A round is two aggregations and two joins; it is written to the
shared checkpoint folder, so lineage stays short and a lost executor costs one
round at most.  Nothing but two scalars a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import discard, materialize


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u long, v long): root is the
    smallest node reachable.  Loops and repeated links are ignored."""
    edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u > v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest(both), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = _smallest(large)
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        after = materialize(small, "stars")
        discard(edges)
        edges, before, state = after, state, _state(after)
        if state == before:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())


def smallest_ids(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root, component_id): for the linked nodes, the smallest node and
    the smallest ``first`` of their component.  ``nodes``: (node, first)."""
    members = materialize(components(links), "members")
    named = members.join(nodes.select("node", "first"), "node")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return members.join(lowest, "root").select("node", "root", "component_id")
