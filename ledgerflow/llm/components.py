"""Connected components of a link table, on Spark.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round is joins and minimum
aggregations over the links, written to the shared folder, so no link table
ever reaches the driver and a lost executor costs one round.  The number of
rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import drop_stage, stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (edges.join(low.select(F.col("a").alias("u"), "m"), F.col("a") == F.col("u"))
             .where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long, any direction)
    that is not its component's smallest node; root is that smallest node.

    Repeated links, self-links and an empty table are allowed.
    """
    oriented = (links.where("a is not null and b is not null and a != b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    current = stage(oriented, "links")
    before = _signature(current)
    while before[0]:
        following = stage(_small_star(_large_star(current)), "links")
        drop_stage(current)
        current, after = following, _signature(following)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Label of each of ``n`` local nodes: the smallest node reachable over
    the links (a[i], b[i]).  Used inside tasks, to send on one link a node
    instead of all pairs."""
    label = np.arange(n, dtype=np.int64)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label
