"""Connected components by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``: the smallest node that each node reaches.

    Each round hooks every node to its smallest neighbour, follows that pointer one
    step further, and carries labels and edges over to what they point to. A pointer
    never leads to a larger node, so the smallest node of a component keeps its own
    label and is the one label left when no edge joins two different ones. A round
    at least halves the chains of pointers. Aggregates run before each exchange, so
    a node with very many edges sends one row per task; every round is written to
    the shared folder. Self-loops and repeated edges are allowed; NULL nodes are not.
    """
    edges = materialize(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialize(nodes.withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        hooks = materialize(
            edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")), "hooks"
        )
        onward = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("further"))
        jumped = hooks.join(onward, "parent", "left").select(
            "node", F.coalesce("further", "parent").alias("parent")
        )
        hooks = materialize(jumped, "jumps")
        edges = materialize(
            _follow(_follow(edges, "a", hooks), "b", hooks)
            .where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "edges",
        )
        labels = materialize(_follow(labels, "component", hooks), "labels")
    return labels


def _follow(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    to = hooks.select(F.col("node").alias(column), F.col("parent").alias("_to"))
    moved = df.join(to, column, "left").withColumn(column, F.coalesce("_to", column))
    return moved.select(df.columns)
