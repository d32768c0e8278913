"""Connected components of links, by alternating stars.

Each round hangs every node on the smallest node it knows, first its larger neighbours and then its smaller ones, until
all are stars; that takes a number of rounds in the order of the logarithm of the number of nodes.  Minima are partial
aggregates, so a node with very many links is no single task, and each round is written, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satchel.llm.scratch import keep


def _hang(directed: DataFrame) -> DataFrame:
    """For each node ``u``: every neighbour ``v`` and ``u`` itself get a link to the smallest node known to ``u``."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    ends = directed.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return ends.unionByName(own).where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other and on none that hangs itself: then nothing is left to do."""
    ends = edges.select(F.explode(F.array(*(F.struct(F.col(c).alias("n"), F.lit(i).alias("up")) for i, c in enumerate("vu")))).alias("e"))
    told = ends.groupBy("e.n").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("low"))
    return told.where("ups > 1 OR (ups = 1 AND low = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links`` (two columns of one orderable type) as ``node, component``; ``component`` is the smallest node reachable.

    Links to oneself and repeated links are allowed and change nothing.  Nodes without a link to another are not in it.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = keep(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(_hang(large), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
