"""Connected components of a link table, and links to what they join in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; component: its smallest node.

    Links are contracted until none is left: each node takes its smallest neighbour, or itself, as
    its parent, and links are moved to the parents. The group-bys combine in each task first, so a
    hub with a third of all links is no hot group. Rounds follow the logarithm of the longest path,
    and each is written to the shared folder. Loops and repeated links do no harm, links with a
    NULL end are left out, and no links give no rows.
    """
    both = links.where("a is not null and b is not null").select("a", "b")
    edges = stage(both.where("a <> b").distinct(), "links")
    parents = []
    while not edges.isEmpty():
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = ways.groupBy("a").agg(F.least("a", F.min("b")).alias("parent"))
        # A parent's own parent is nearer to the smallest node and spares a round.
        near = stage(parent.withColumnRenamed("a", "node"), "parents")
        up = near.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        far = stage(
            near.join(up, "parent").select("node", F.col("grand").alias("parent")), "grandparents"
        )
        parents.append(far)
        of = lambda end: far.select(F.col("node").alias(end), F.col("parent").alias(f"{end}2"))
        moved = edges.join(of("a"), "a").join(of("b"), "b").select(
            F.col("a2").alias("a"), F.col("b2").alias("b")
        )
        edges = stage(moved.where("a <> b").distinct(), "links")
    if not parents:
        kind = dict(links.dtypes)["a"]
        return links.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    labels = parents[0].select("node", F.col("parent").alias("component"))
    for later in parents[1:]:
        step = later.select(F.col("node").alias("component"), F.col("parent").alias("next"))
        labels = labels.join(step, "component", "left").select(
            "node", F.coalesce("next", "component").alias("component")
        )
    return labels


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node joined to each of ``count`` nodes by the pairs ``a``-``b``."""
    root = np.arange(count)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        apart = root[a] != root[b]
        if np.array_equal(before, root) and not apart.any():
            break
        a, b = a[apart], b[apart]
    return root
