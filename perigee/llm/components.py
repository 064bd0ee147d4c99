"""Connected components of an edge list, by alternating star contraction.

Each round replaces every node's neighbours by edges to its smallest neighbour: first among
larger neighbours (large star), then among smaller ones (small star). Rounds needed grow with
the logarithm of the number of nodes. A node's neighbours are never gathered: a round is one
``min`` (combined before the shuffle) and one join, which adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import stored


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v), any order, repeats allowed. Returns node, root (smallest of its component).

    Links with a null end are ignored. A link from a node to itself makes it a component.
    """
    given = links.where("u is not null and v is not null")
    edges = stored(given.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = edges.where("u = v")
        edges = stored(large.unionByName(kept).distinct(), "links")
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    tree = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tree.unionByName(tree.select(F.col("root").alias("node"), "root")).groupBy("node").agg(F.min("root").alias("root"))
