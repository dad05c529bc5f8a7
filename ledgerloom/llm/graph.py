"""Connected components of an edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import discard, materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % 1_000_003)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the component's smallest node.

    Each round hangs every node below the smallest neighbour it knows. A hub costs one
    partially aggregated minimum and one join (which adaptive execution splits); its
    neighbours are never gathered. Loops and null ends are ignored; no edge gives no row.
    The rounds are logarithmic in the longest path; each is written to the shared folder.
    """
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "edges",
    )
    was = None
    while True:  # each round that changes an edge lowers a root, so it ends
        state = _state(now)
        if state == was or not state[0]:
            roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
        was = state
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        met = large.join(least, "hi")
        small = met.select("hi", F.col("m").alias("lo")).unionByName(
            met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        before, now = now, materialise(small.distinct(), "edges")
        discard(before)
