"""Connected components by repeated minimum labels, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

ROWS_PER_FILE = 250_000


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b`` (bigint) -> ``node``, ``comp``: the least node of each component.

    A round takes the least label among a node and its neighbours and then that label's own label, so the distance
    covered doubles; only the count of changed labels comes to the driver.  Minima are summed map side; labels reach the edges of
    a node with very many neighbours by a sort-merge join, whose large partitions adaptive execution splits.  The tables are written in
    files of ROWS_PER_FILE rows, as rounds over many tiny files cost more than their rows.
    """
    both = stage(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    parts = max(1, -(-both.count() // ROWS_PER_FILE))
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node")
    labels = stage(labels.coalesce(parts), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("__near"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "comp", F.least("comp", "__near").alias("__next"))
        jump = labels.select(F.col("node").alias("__next"), F.col("comp").alias("__jump"))
        moved = stage(
            met.join(jump, "__next").select("node", F.least("__next", "__jump").alias("comp"), (F.least("__next", "__jump") < F.col("comp")).alias("moved"))
            .coalesce(parts),
            "labels",
        )
        labels = moved.select("node", "comp")
        if moved.where("moved").isEmpty():
            return labels


def grown(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` with further edges: only the components that these touch are joined, one node each; edges met before are not read again."""
    root = lambda end: comps.select(F.col("node").alias(end), F.col("comp").alias(f"root_{end}"))
    between = edges.select("a", "b").join(root("a"), "a", "left").join(root("b"), "b", "left")
    between = between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a != b").distinct()
    more = components(between)
    joined = comps.join(more.select(F.col("node").alias("comp"), F.col("comp").alias("__to")), "comp", "left")
    alone = more.join(comps, "node", "left_anti").select("node", "comp")
    return stage(joined.select("node", F.coalesce("__to", "comp").alias("comp")).unionByName(alone), "comps")
