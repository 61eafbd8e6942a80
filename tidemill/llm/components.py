"""Connected components of an edge table, by rounds of joins.

Every round each node takes its smallest neighbour (or itself) as parent, chains of parents are
shortened until stable, and the edges are contracted onto the roots.  At least half of the
roots that still have edges disappear per round.  All tables of a round are written to the
shared folder; nothing is gathered on the driver but one count a step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: bigint) -> (node, root): every node of an edge, and the smallest node of
    its component.  Loops and repeated edges are allowed; an empty table gives an empty result."""
    edges = staged(_tidy(edges), "cc-edges")
    mapping = None
    while True:
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).union(
            edges.select(F.col("v").alias("node"), F.col("u").alias("other")))
        parents = staged(both.groupBy("node").agg(F.min("other").alias("other"))
                         .select("node", F.least("node", "other").alias("root")), "cc-parents")
        parents = _shorten(parents)
        if mapping is None:
            mapping = parents
        else:
            p = parents.select(F.col("node").alias("p_node"), F.col("root").alias("p_root"))
            mapping = staged(mapping.join(p, mapping["root"] == p["p_node"], "left")
                             .select("node", F.coalesce("p_root", "root").alias("root")), "cc-map")
        pu = parents.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        pv = parents.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        edges = staged(_tidy(edges.join(pu, "u").join(pv, "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))),
                       "cc-edges")
        if edges.isEmpty():
            return mapping


def _tidy(edges: DataFrame) -> DataFrame:
    e = edges.where("u <> v")
    return e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _shorten(parents: DataFrame) -> DataFrame:
    """Pointer jumping until every node points at a root."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
        nxt = staged(parents.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")),
                     "cc-jump")
        parents = nxt.select("node", "root")
        if nxt.where("moved").isEmpty():
            return parents


def local_forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a[i], b[i]) among nodes 0..n-1 -> a star for each component: (node, root) without roots."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]
