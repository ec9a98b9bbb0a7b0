"""Connected components of an edge table: union-find inside tasks, stars across them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally.sources.workspace import stored


def _union_find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a task's batches, each batch as stars around its smallest nodes."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        yield pd.DataFrame({"a": nodes, "b": [parent[x] for x in nodes]}, dtype="int64")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's (large: larger, small: smaller) neighbours move to its smallest neighbour.

    A node with very many neighbours is one key of the join; only its own row is on the other side.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.union(turned) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = around.join(least, "a").where("b > a" if large else "b <> m").select(F.col("b").alias("x"), "m")
    if not large:
        moved = moved.union(least.select(F.col("a").alias("x"), "m"))
    return moved.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (longs ``a``, ``b``); root is its component's smallest node.

    Repeated edges, loops and an empty table are fine; nulls are left out.
    """
    edges = edges.where("a <> b").select("a", "b")
    edges = stored(edges.mapInPandas(_union_find, "a long, b long").distinct(), "edges")
    state = None
    while True:
        edges = stored(_stars(_stars(edges, large=True), large=False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
