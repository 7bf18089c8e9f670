"""Connected components of a link table, and the cells in which links are looked for.

Buckets of candidates are cut into blocks of bounded size and every pair of blocks of a bucket is one
cell, so no bucket, however hot, lies in one task, and no candidate pair is ever a row: a cell hands
back at most one link for each of its members.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from variantloom.llm.common import stored

MOST_ROUNDS = 60


def components(links):
    """``node, component`` for each node of ``links(a, b)``; the component is named by its smallest node.

    Alternating star contraction: nodes hand their larger, then their smaller neighbours to their
    smallest one until the links are stars. Links to itself and nulls are left out.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(near, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b")).distinct())
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(near, "a")
        small = (moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(near.select("a", "m"))
                 .filter("a <> b").distinct())
        edges = stored(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct())
        before = now
    raise RuntimeError("the links did not contract to stars")


def cells(members, key, item, size, block):
    """Rows of ``members`` with the cell ``(key, left, right)`` they meet the others in.

    ``size``: a column with the count of the bucket's members. A bucket of more than ``block`` members is
    dealt out over blocks by ``item``; ``own`` is the member's block.
    """
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (members.withColumn("blocks", blocks)
            .withColumn("own", F.pmod(F.xxhash64(item), F.col("blocks")).cast("int"))
            .select("*", other.alias("other"))
            .withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other"))
            .drop("other", "blocks"))


def roots(linked):
    """For each row of a symmetric boolean matrix, the first row it is connected with."""
    count = len(linked)
    label = np.full(count, -1)
    for start in range(count):
        if label[start] < 0:
            label[start] = start
            front = np.array([start])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (label < 0))
                label[front] = start
    return label
