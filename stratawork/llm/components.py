"""Connected components of a graph given as edges, by alternating star contractions.

Each large-star step hangs a node's greater neighbours onto its smallest neighbour, each
small-star step does so with its smaller neighbours; the number of steps grows with the logarithm
of the graph's size. Every step is two grouped minima and two joins of written tables, so a node
with very many edges is split by adaptive execution and never gathered. The first minima also tell whether
all edges are stars by now, so no step is made to see that nothing changes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .storage import kept

#: Edges for which a step has one more task; each task writes a file of its own.
TASK_EDGES = 100_000


def star_edges(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of a small graph over nodes 0..n-1: (smallest node, other node)."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            break
    other = np.nonzero(root != np.arange(n))[0]
    return root[other], other


def _smallest(pairs: DataFrame, tasks: int) -> DataFrame:
    """``of`` and ``low``, the smallest of its neighbours and itself, and whether it hangs on one node alone or on none (``done``)."""
    smaller, greater = F.count_if(F.col("to") < F.col("hub")), F.count_if(F.col("to") > F.col("hub"))
    done = (smaller == 0) | ((smaller == 1) & (greater == 0))
    low = pairs.groupBy("hub").agg(F.min(F.least("hub", "to")).alias("low"), done.alias("done"))
    return kept(low.withColumnRenamed("hub", "of").coalesce(tasks), "stars")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, for every node of edges ``a``, ``b`` (long).

    Loops and repeated edges do no harm; edges with a NULL end are ignored. No edges, no rows.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    pairs = kept(pairs.distinct(), "edges")
    # no step makes more edges
    tasks = max(pairs.sparkSession.sparkContext.defaultParallelism, -(-pairs.count() // TASK_EDGES))
    while True:
        both = pairs.select(F.col("hi").alias("hub"), F.col("lo").alias("to"))
        both = both.unionByName(pairs.select(F.col("lo").alias("hub"), F.col("hi").alias("to")))
        low = _smallest(both, tasks)
        if low.filter("not done").isEmpty():
            break
        # one row per edge at most; repeated ones go with those of the small star
        large = both.join(low, both["hub"] == low["of"]).filter("to > hub").select(F.col("to").alias("hub"), F.col("low").alias("to"))
        large = kept(large.filter("hub <> to").coalesce(tasks), "large-star")
        low = _smallest(large, tasks)
        met = large.join(low, large["hub"] == low["of"])
        small = met.select(F.col("to").alias("hi"), F.col("low").alias("lo")).unionByName(met.select(F.col("hub").alias("hi"), F.col("low").alias("lo")))
        pairs = kept(small.filter("hi <> lo").distinct().coalesce(tasks), "small-star")
    roots = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
