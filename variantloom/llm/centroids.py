"""Centroid clustering with Ns-bounds: exact rounds of k-means that skip most distances.

Every vector keeps, for each centroid, the distance that was last computed to it and the round of that
computation. The places of all centroids in all rounds so far are kept too (``clusters`` x ``rounds``
vectors, a bound of the parameters). A stored distance is loosened by the norm of the centroid's *total*
displacement since that round, which is never more than the sum of its drifts, as steps that turn back
cancel out. A centroid whose loosened bound is above the distance to the own centroid cannot be the
nearest; every other one is a failed bound and its distance is computed anew, in integers, so assignments
equal those of a full scan, ties included (they go to the smaller number).

A round is one pass over a stored table of vectors and bounds that writes the next one, and one sum for
each cluster: tasks hand back one row for each cluster they met. Nothing is shuffled but these sums, so no
cluster, however large, lies in one task.

Vectors that are null, that have another length than ``width``, or hold nulls or values that are not
finite are left out of the result. Components become ``floor(scale * x)``; one whose integer reaches
2 ** 27 raises, as squared distances would not fit a long. The start takes the ``clusters`` vectors with the
smallest hash of seed and id; rows that repeat an id are vectors of their own, ordered by their components,
and so may start several centroids. Rows without an id are assigned like any other but start nothing. Fewer vectors
than ``clusters`` make fewer centroids; an empty table an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.llm.common import written

MOST = 1 << 27
AT_ONCE = 4096
# Distances are kept as 32-bit floats; bounds give way by this much for their rounding.
SLACK = 1e-6

STATE = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int32())), ("cluster", pa.int32()), ("distance", pa.int64()),
                   ("far", pa.list_(pa.float32())), ("seen", pa.list_(pa.int8())), ("computed", pa.int32())])
STATE_SQL = "vec_id long, v array<int>, cluster int, distance long, far array<float>, seen array<byte>, computed int"


def integers(vectors, width, scale, id_col, vector_col):
    """``vec_id, v`` of the vectors that take part."""
    values = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.forall("x", lambda x: F.abs(x * scale) < MOST)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), values.alias("x"),
                          F.coalesce((F.size(values) == width) & finite, F.lit(False)).alias("sound")).filter("sound")
    v = F.when(small, F.transform("x", lambda x: F.floor(x * scale).cast("int"))).otherwise(
        F.raise_error(F.lit("a component is too large for squared distances in 64 bits")).cast("array<int>"))
    return rows.select("vec_id", v.alias("v"))


def start(rows, clusters, seed):
    """Vectors with the smallest hashes, in order of the hash."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.filter("vec_id IS NOT NULL").select(hashed.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([row["v"] for row in first], np.int64)


def squared(a, b):
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def displacements(history):
    """``[round, centroid]``: norm of the way from the centroid's place in the round to its present one, rounded up."""
    now = history[-1].astype(np.float64)
    return np.stack([np.sqrt(((now - then) ** 2).sum(axis=1)) for then in history]) * (1 + SLACK)


def assign(v, own, far, seen, history):
    """New ``own, distance, far, seen`` and how many distances were computed, for a block of vectors."""
    centroids, now = history[-1], len(history) - 1
    every = np.arange(len(v))
    exact = np.full(far.shape, np.iinfo(np.int64).max)
    exact[every, own] = squared(v, centroids[own])
    upper = np.sqrt(exact[every, own].astype(np.float64))
    loosened = far * (1 - SLACK) - displacements(history)[seen, np.arange(far.shape[1])]
    failed = loosened <= (upper * (1 + SLACK))[:, None]
    failed[every, own] = False
    rows, columns = np.nonzero(failed)
    exact[rows, columns] = squared(v[rows], centroids[columns])
    failed[every, own] = True
    far = np.where(failed, np.sqrt(exact.astype(np.float64)), far).astype(np.float32)
    seen = np.where(failed, np.int8(now), seen).astype(np.int8)
    own = exact.argmin(axis=1).astype(np.int32)  # the first of equal ones
    return own, exact[every, own], far, seen, failed.sum(axis=1).astype(np.int32)


def lists(column, dtype):
    """Rows of a list column as one array; all lists are of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def list_column(array, kind):
    ends = np.arange(len(array) + 1, dtype=np.int32) * array.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(array.ravel(), kind))


def assign_all(history):
    """Function of Arrow batches: the state after assignment to the last places in ``history``.

    Batches without bounds are the first round's: zero is a lower bound of every distance.
    """
    k = len(history[-1])

    def run(source):
        for whole in source:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                v = lists(batch.column("v"), np.int64)
                if "far" in batch.schema.names:
                    own = batch.column("cluster").to_numpy()
                    far, seen = lists(batch.column("far"), np.float32), lists(batch.column("seen"), np.int8)
                else:
                    own = np.zeros(len(v), np.int32)
                    far, seen = np.zeros((len(v), k), np.float32), np.zeros((len(v), k), np.int8)
                own, distance, far, seen, computed = assign(v, own, far, seen, history)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), list_column(v.astype(np.int32), pa.int32()), pa.array(own, pa.int32()), pa.array(distance, pa.int64()),
                     list_column(far, pa.float32()), list_column(seen, pa.int8()), pa.array(computed, pa.int32())], schema=STATE)

    return run


def sums(source):
    """Of one task's batches: ``cluster, n, total``, one row for each cluster that was met."""
    total, n = {}, {}
    for batch in source:
        own, v = batch.column("cluster").to_numpy(), lists(batch.column("v"), np.int64)
        for c in np.unique(own).tolist():
            mine = v[own == c]
            total[c] = total.get(c, 0) + mine.sum(axis=0)
            n[c] = n.get(c, 0) + len(mine)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([n[c] for c in total], pa.int64()),
                                      pa.array([total[c].tolist() for c in total], pa.list_(pa.int64()))], names=["cluster", "n", "total"])


def moved(state, centroids):
    """Componentwise floor of the mean of each cluster; an empty one stays. Collects ``clusters`` x ``width`` sums."""
    parts = state.select("cluster", "v").mapInArrow(sums, "cluster int, n long, total array<long>")
    whole = (parts.select("cluster", "n", F.posexplode("total").alias("place", "x")).groupBy("cluster", "place")
             .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")))
    centroids = centroids.copy()
    for row in whole.collect():
        centroids[row["cluster"], row["place"]] = int(row["x"]) // row["n"]
    return centroids


def assigned(vectors, clusters=16, rounds=3, scale=64, width=64, seed=1, id_col="vec_id", vector_col="embedding"):
    """``(state, centroids)`` after ``rounds`` rounds and a last assignment; ``state`` also has how many distances a vector took."""
    rows = integers(vectors, width, scale, id_col, vector_col)
    history = [start(rows, clusters, seed)]
    if not len(history[0]):
        return rows.sparkSession.createDataFrame([], STATE_SQL), history[0]
    state = rows
    for _ in range(rounds):
        state = written(state.mapInArrow(assign_all(list(history)), STATE_SQL))
        history.append(moved(state, history[-1]))
    return state.mapInArrow(assign_all(history), STATE_SQL), history[-1]


def digest(centroid):
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors, clusters=16, rounds=3, **options):
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector that takes part.

    Sums of distances that do not fit a long are null.
    """
    state, centroids = assigned(vectors, clusters, rounds, **options)
    rows = written(state.select("vec_id", "cluster", "distance"))
    names = rows.sparkSession.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    inertia = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    # one row for each cluster
    by_cluster = names.join(inertia, "cluster").withColumn("inertia", F.try_sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    return rows.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
