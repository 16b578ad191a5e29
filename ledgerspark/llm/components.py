"""Connected components, locally in numpy and over a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the edges (a, b) lead to."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of the edges (a, b): label is the least node of its component.

    Large-star and small-star steps in turn, until nothing changes.  Each step
    sends a node's neighbours to its least one; the least one is found by an
    aggregate, which combines before the shuffle, so a node with very many
    neighbours costs one row a task, and the join back can be split.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    state = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        before, now = now, written(small.filter("a > b").distinct(), "edges")
        discard(edges.sparkSession, [before.written_to])
        was, state = state, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
    raise RuntimeError(f"components are not settled after {rounds} rounds")
