"""Connected components by contraction, all in DataFrames.

Each round every node takes the smallest of itself and its neighbours as parent, edges are
carried over to the parents (twice, so that chains shorten faster), and loops and repeats
go.  At least half of the nodes that still have an edge vanish in a round.  A node's label
ends as the smallest node of its component, since the smallest is always its own parent.
Each round's tables are written to the shared folder.  Edge cases: no edges, no labels; loops and repeated
edges don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fits, join_on_hot_key, written


def _renamed(rows: DataFrame, column: str, names: DataFrame, small: bool, salt_by: str) -> DataFrame:
    """``rows`` with the name (names: v, to) instead of the node in ``column``, where it has one.  Small names are
    broadcast; else nodes that many rows hold are split."""
    to = names.select(F.col("v").alias(column), "to")
    if small:
        joined = rows.join(F.broadcast(to), column, "left")
    else:
        weighed = written(to.join(rows.groupBy(column).agg(F.count("*").alias("_rows")), column), "weighed_names")
        joined = join_on_hot_key(rows, weighed, column, "_rows", F.col(salt_by))
    return joined.withColumn(column, F.coalesce("to", column)).drop("to")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b; longs).  A node may have any share of the edges."""
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while edges.head(1):
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        parents = written(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("to")), "parents")
        small = fits(parents)
        twice = _renamed(parents.withColumnRenamed("to", "up"), "up", parents, small, "v")
        parents = written(twice.select("v", F.col("up").alias("to")), "grandparents")
        labels = parents.select(F.col("v").alias("node"), F.col("to").alias("label")) if labels is None else written(_renamed(labels, "label", parents, small, "node"), "labels")
        moved = _renamed(_renamed(edges, "a", parents, small, "b"), "b", parents, small, "a")
        edges = written(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.select("node", "label")
