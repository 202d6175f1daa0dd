"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every round re-hangs each
node's neighbours on the smallest one, so paths shrink geometrically. Each
round is one or two grouped minimums and joins over at most two rows an edge;
no neighbour list is ever collected, so a node with very many neighbours is
no more than many rows of a shuffle with map-side minimums. Rounds are
written as stages (lineage is cut, lost executors cost one round), and the
driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.plans.stages import drop_stage, write_stage

MAX_ROUNDS = 60  # paths shrink geometrically; reached only by a fault


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("u"), F.col("v").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of a node on the smallest of itself and
    its neighbours."""
    arcs = _both_ways(edges)
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (arcs.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("m").alias("u"), "v").where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of these.
    Edges come with u < v."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    hung = edges.join(least, "v").where(F.col("u") != F.col("m")).select(F.col("m").alias("u"), F.col("u").alias("v"))
    return hung.union(least.select(F.col("m").alias("u"), "v")).distinct()


def component_labels(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, component): the smallest node that each node reaches. ``edges``
    has columns u and v in any order; loops, repeats and rows with a null end
    are ignored. Nodes without an edge to another node aren't listed. An
    empty edge list gives an empty result."""
    now = write_stage(edges.where(F.col("u") != F.col("v"))
                      .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        new = write_stage(_small_star(_large_star(now)), "cc")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        drop_stage(now)
        now = new
        if state == before:
            return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
                now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
