"""Connected components of a distributed edge list, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.llm.shared import staged


def _roots(parent: DataFrame) -> DataFrame:
    """Follow ``v -> p`` to the end of every chain by doubling the steps. ``p < v`` but at roots."""
    while True:
        above = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        doubled = staged(
            parent.join(above, "p").select("v", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")), "roots"
        )
        parent = doubled.select("v", "p")
        if doubled.filter("moved").isEmpty():
            return parent


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an undirected edge list; the component is its least node.

    Each round hooks every node to its least neighbour, follows the hooks to
    their roots, and contracts the edges to edges between roots, so each
    component at least halves. All steps are aggregates with partial sums and
    joins, so a hub with any number of edges is never gathered in one place.
    Null ends and edges from a node to itself are left out. The driver sees one
    truth value a round.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    label = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p"))
        root = _roots(staged(hook, "hooks"))
        if label is None:
            label = root
        else:
            step = root.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            label = staged(label.join(step, "p", "left").select("v", F.coalesce("pp", "p").alias("p")), "labels")
        ra, rb = root.select(F.col("v").alias("a"), F.col("p").alias("ra")), root.select(F.col("v").alias("b"), F.col("p").alias("rb"))
        edges = staged(
            edges.join(ra, "a").join(rb, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges"
        )
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return label.select(F.col("v").alias("node"), F.col("p").alias("component"))
