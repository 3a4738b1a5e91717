"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def join_up(pairs: np.ndarray) -> np.ndarray:
    """The distinct ends of the links (n x 2 numbers) and the smallest of each one's component."""
    nodes, ends = np.unique(pairs, return_inverse=True)
    ends = ends.reshape(-1, 2)
    label = np.arange(len(nodes))
    while True:
        least = label[ends].min(axis=1)
        new = label.copy()
        np.minimum.at(new, label[ends[:, 0]], least)
        np.minimum.at(new, label[ends[:, 1]], least)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return np.stack([nodes, nodes[label]], axis=1)
        label = new


def _stars(batches):
    """Links of one batch as stars about their smallest ends: as connected as before, and fewer."""
    for batch in batches:
        if batch.num_rows:
            stars = join_up(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1))
            stars = stars[stars[:, 0] != stars[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(stars[:, 0]), pa.array(stars[:, 1])], names=["u", "v"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for each node of the links ``(u long, v long)``.

    No links give no rows; a node that links with itself only is its own component. A node with
    very many links is no hot key for long: each round hangs its neighbours on the smallest one,
    sums are made before the shuffle, and the join back is one that Spark can split.
    """
    links = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u is not null and v is not null")
    loops = links.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    edges = links.where("u <> v").mapInArrow(_stars, "u long, v long").distinct()
    edges = common.written(edges, name)
    while True:
        # Large star: what is above u hangs on the smallest of u and all that u touches.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.w).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u, and what is below it, hangs on the smallest of those.
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.withColumnRenamed("u", "w").join(below, F.col("w") == below.u).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(below.select("u", F.col("m").alias("v"))).distinct()
        after = common.written(small, name)
        # Stars about the smallest are done: each node hangs on one other, which hangs on none.
        stars = after.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        middle = after.select(F.col("v").alias("u")).distinct().join(after, "u", "left_semi")
        if stars.where("n > 1").isEmpty() and middle.isEmpty():
            break
        edges = after
    found = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    alone = loops.distinct().join(found.union(roots), "node", "left_anti")
    return found.union(roots).union(alone)
