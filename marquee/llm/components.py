"""Connected components of an edge table by repeated minimum contraction.

Each round points every vertex at its least neighbour (or itself), follows the pointers once more, renames the edges and drops
those inside a component. Every vertex that is not a local minimum merges, so the number of rounds is small; each round is a
few joins and aggregations with partial minima, written to the shared folder, so that a lost executor costs one round at
most. Nothing is collected; the driver sees one count per round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(vertex, label) for every vertex of edges(u, v), label the least vertex of its component."""
    spark = edges.sparkSession
    edges = materialize(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hop = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("p")), "cc-hop")
        # two steps: a vertex that chose p moves on to what p chose
        jump = materialize(hop.alias("a").join(hop.alias("b"), F.col("a.p") == F.col("b.u"))
                           .select(F.col("a.u").alias("u"), F.col("b.p").alias("p")), "cc-jump")
        if labels is None:
            labels = jump.select(F.col("u").alias("vertex"), F.col("p").alias("label"))
        else:
            labels = materialize(labels.join(jump, F.col("label") == F.col("u"), "left")
                                 .select("vertex", F.coalesce("p", "label").alias("label")), "cc-labels")
        moved = (edges.join(jump.select(F.col("u"), F.col("p").alias("pu")), "u")
                 .join(jump.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v"))
        edges = materialize(moved.where("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
                            .distinct(), "cc-edges")
    return labels if labels is not None else spark.createDataFrame([], "vertex long, label long")
