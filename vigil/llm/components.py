"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.base import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp = smallest node reachable.

    Each round replaces the edges by edges between the current labels (self-loops and
    repetitions go), so the graph shrinks; labels stay in Spark tables, only a row count
    reaches the driver. Hot nodes: the per-node minimum is a partial aggregate and the joins
    are plain equi-joins that AQE can split.
    """
    both = lambda e: e.select("a", "b").unionByName(
        e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    labels = None
    while True:
        step = (both(edges).groupBy(F.col("a").alias("node"))
                .agg(F.min("b").alias("m"))
                .select("node", F.least("node", "m").alias("comp")))
        # pointer jumping over the parents of this round, twice
        for _ in range(2):
            up = step.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
            step = step.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
        step = materialize(step, "cc-step")
        if labels is None:
            labels = step
        else:
            up = step.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
            labels = materialize(
                labels.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")),
                "cc-labels")
        to = lambda c: step.select(F.col("node").alias(c), F.col("comp").alias(f"{c}2"))
        edges = materialize(
            edges.join(to("a"), "a").join(to("b"), "b")
            .select(F.col("a2").alias("a"), F.col("b2").alias("b"))
            .filter("a <> b").distinct(), "cc-edges")
        if edges.isEmpty():
            return labels
