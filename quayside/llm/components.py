"""Connected components by alternating large-star and small-star steps.

Every step is one grouped aggregation and one join over the edge list; the
edges are written to the shared folder after each round, so the lineage stays
one round deep and the driver only ever sees two numbers per round.  The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over (u, v) pairs with u > v, unique.

    large: each node links its larger neighbours to the smallest node it sees.
    small: each node links its smaller neighbours and itself to that node.
    A hub's neighbourhood is never gathered: its minimum is a partial aggregate.
    The minima are stored, so that the join reads both sides by plain shuffles
    and AQE can split a hub's edges over many tasks.
    """
    if small:
        near = edges
    else:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stored(near.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m")), "cc-lowest")
    step = near.join(low, "u")
    if small:
        out = step.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = step.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, label)``, label = smallest node reachable.

    Self loops and NULL ends are ignored; nodes without an edge have no row.
    """
    e = (edges.filter("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(e, "cc-edges")
    state = lambda x: x.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    before = state(e)
    while before[0]:
        e = stored(_star(stored(_star(e, small=False), "cc-large"), small=True), "cc-edges")
        now = state(e)
        if now == before:  # every edge leads from a node to its root
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("label")))
