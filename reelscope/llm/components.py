"""Connected components of a link table, entirely in Spark.

Each round hooks every component to its smallest neighbour (a partial
aggregate, so a hub does not meet in one task), follows the hooks to their
roots by pointer doubling, and contracts the links.  Labels only ever
decrease to the smallest id of the tree, so the final label is the smallest
node of the component.  Every table of a round is written to the shared
folder: lineage stays short, joins read plain tables that adaptive execution
can split at a hub, and nothing but row counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging


def _roots(parent: DataFrame, stage: Staging, label: str) -> DataFrame:
    """Follow ``p`` until every node points at a root; a table is written only where that moves one."""
    step = 0
    while True:
        up = parent.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        if parent.join(up.where("p <> pp"), "p", "left_semi").isEmpty():
            return parent
        parent = stage.write(parent.join(up, "p").select("c", F.col("pp").alias("p")), f"{label}-jump{step}")
        step += 1


def connected_components(links: DataFrame, stage: Staging, label: str = "cc") -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a``, ``b``).

    ``component`` is the smallest node reachable.  Links of a node with
    itself, repeated and reversed links are harmless; links with a null end
    are ignored; no links give an empty result.
    """
    edges = stage.write(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{label}-edges",
    )
    labels = None
    turn = 0
    while True:
        ends = edges.select(F.col("a").alias("c"), F.col("b").alias("o")).unionByName(
            edges.select(F.col("b").alias("c"), F.col("a").alias("o"))
        )
        hook = ends.groupBy("c").agg(F.min("o").alias("o")).select("c", F.least("c", "o").alias("p"))
        root = _roots(stage.write(hook, f"{label}-hook{turn}"), stage, f"{label}-{turn}")
        if labels is None:
            labels = root.select(F.col("c").alias("node"), F.col("p").alias("component"))
        else:
            labels = labels.join(root.withColumnRenamed("c", "component"), "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")
            )
            labels = stage.write(labels, f"{label}-labels{turn}")
        edges = stage.write(
            edges.join(root.select(F.col("c").alias("a"), F.col("p").alias("pa")), "a")
            .join(root.select(F.col("c").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            f"{label}-edges{turn}",
        )
        if edges.isEmpty():
            return labels
        turn += 1
