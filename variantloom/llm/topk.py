"""Exact top-k search by inner product with a uniform threshold in three phases.

A vector's components are cut into slices. A query's score is the sum of its partial scores in the
slices, so each slice of each block of vectors is a list of local scores.

1. Gather: the lists of one vector block in ``GATHERED`` give the query their highest local scores. The vectors seen
   are scored in full; the k-th best full score, of whichever vectors, is a safe lower bound of the k-th best of all.
2. Cutoff: the bound and its share for one slice, the uniform cutoff, go to every list. Lists are read one after the
   other. An entry is out, and neither read nor multiplied in the lists that follow, once its known local scores plus
   the products of norms in the slices not read cannot reach the bound. A vector below the cutoff in every
   slice sums to less than the bound, so before the last list only those are collected that reached the cutoff or may
   reach it there.
3. Resolve: the last list is read for collected entries alone, whose exact scores are ranked.

Queries are met with vectors in blocks; a block of queries or of vectors is of bounded size, and what a
block pair hands on is at most k entries a slice, then k exact scores, for each query.

Vectors that are null, empty, or hold nulls or values that are not finite take no part, as queries or as
candidates, nor do those that differ in length from most, nor rows without an id. A query meets every row but
itself: rows that repeat a query's id are left out with it, and the id asks once, with the least of its vectors. As
candidates of other queries all rows of an id count. Scores are integers; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.llm.common import stored

SLICES = 8
GATHERED = 16
DENSE = 8  # lists are read entry by entry once fewer than one in DENSE are left, before that by matrices
QUERY_BLOCK, VECTOR_BLOCK, AT_ONCE = 8192, 4096, 512
EXACT = 2.0 ** 53


def quantized(vectors, id_col, vector_col, scale):
    """``vec_id`` and ``v``, the vector as ``floor(scale * x)`` in longs, of rows that take part."""
    values = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), values.alias("x"),
                          F.coalesce((F.size(values) > 0) & finite, F.lit(False)).alias("sound"))
    rows = rows.filter("sound AND vec_id IS NOT NULL").drop("sound")
    usual = rows.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if usual is not None:
        rows = rows.filter(F.size("x") == usual["n"])
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def matrix(column):
    return np.stack(column.to_numpy()).astype(np.int64)


def product(a, b):
    """Integer inner products; through floating point where that is exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def slices(width):
    return [slice(*x) for x in zip(*(lambda e: (e[:-1], e[1:]))([width * i // SLICES for i in range(SLICES + 1)])) if x[0] < x[1]]


NONE = -(1 << 55)  # a local score below all others: of a query and its own row


def masked(scores, query_ids, ids):
    scores[query_ids[:, None] == ids[None, :]] = NONE
    return scores


def top(scores, count):
    """Rows and columns of ``count`` highest scores of each row; which of several equal ones does not matter here."""
    count = min(count, scores.shape[1])
    best = np.argpartition(scores, scores.shape[1] - count, axis=1)[:, scores.shape[1] - count:]
    rows = np.repeat(np.arange(len(scores)), best.shape[1])
    columns = best.ravel()
    real = scores[rows, columns] > NONE
    return rows[real], columns[real]


def block_pair(phase, count, multiplied=None):
    """Function of one block of queries with one block of vectors: the phase's rows, a few queries at once."""
    def run(key, cell):
        queries, others = cell[cell["is_query"]], cell[~cell["is_query"]]
        found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)]
        if len(others):
            v, ids = matrix(others["v"]), others["vec_id"].to_numpy()
            for at in range(0, len(queries), AT_ONCE):
                part = queries.iloc[at:at + AT_ONCE]
                query_ids = part["vec_id"].to_numpy()
                rows, found_ids, scores, work = phase(matrix(part["v"]), query_ids, part["bound"].to_numpy(), v, ids, count)
                if multiplied is not None:
                    multiplied.add(int(work))
                found.append(pd.DataFrame({"query_id": query_ids[rows], "vec_id": found_ids, "score": scores}))
        return pd.concat(found)

    return run


def gather(q, query_ids, bound, v, ids, count):
    """Phase 1: each list's highest entries, scored in full. The last value counts multiplied components."""
    seen = [top(masked(product(q[:, s], v[:, s]), query_ids, ids), count) for s in slices(q.shape[1])]
    pairs = np.unique(np.concatenate([rows * len(ids) + columns for rows, columns in seen]))
    rows, columns = pairs // len(ids), pairs % len(ids)
    return rows, ids[columns], (q[rows] * v[columns]).sum(axis=1), q.size * len(ids) + len(rows) * q.shape[1]


def list_norms(x, parts):
    """Euclidean norm of every vector's part in every list, rounded up."""
    return np.stack([np.sqrt((x[:, s].astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9) for s in parts], axis=1)


def resolve(q, query_ids, bound, v, ids, count):
    """Phases 2 and 3: lists read in turn for the entries that can still reach the bound, then exact scores."""
    bound, parts = bound.astype(np.int64)[:, None], slices(q.shape[1])
    cutoff = -(-bound // len(parts))  # the least integer that is not below the bound's share
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < EXACT:  # all sums are exact as doubles
        q, v = q.astype(np.float64), v.astype(np.float64)
    q_norms, v_norms = list_norms(q, parts), list_norms(v, parts)
    scores, collected = np.zeros((len(q), len(ids)), v.dtype), np.zeros((len(q), len(ids)), bool)
    left = query_ids[:, None] != ids[None, :]
    read = work = 0
    # by matrices, over vectors that some query still asks for, while many entries are left
    while read < len(parts) and np.count_nonzero(left) * DENSE >= left.size > 0:
        local = q[:, parts[read]] @ v[:, parts[read]].T
        work += local.size * (parts[read].stop - parts[read].start)
        collected |= local >= cutoff
        scores += local
        read += 1
        left &= scores + q_norms[:, read:] @ v_norms[:, read:].T >= bound
        met = left.any(axis=0)
        if not met.all():
            left, scores, collected = left[:, met], scores[:, met], collected[:, met]
            v, v_norms, ids = v[met], v_norms[met], ids[met]
    rows, columns = np.nonzero(left)
    scores, collected, bound, cutoff = scores[rows, columns], collected[rows, columns], bound[rows, 0], cutoff[rows, 0]
    # entry by entry, once few are left
    for number in range(read, len(parts)):
        if number == len(parts) - 1:  # what no list has collected so far has to reach the cutoff in the last one
            left = collected | (q_norms[rows, number] * v_norms[columns, number] >= cutoff)
            rows, columns, scores, collected, bound, cutoff = (x[left] for x in (rows, columns, scores, collected, bound, cutoff))
        local = (q[rows, parts[number]] * v[columns, parts[number]]).sum(axis=1)
        work += local.size * (parts[number].stop - parts[number].start)
        scores, collected = scores + local, collected | (local >= cutoff)
        left = scores + (q_norms[rows, number + 1:] * v_norms[columns, number + 1:]).sum(axis=1) >= bound
        rows, columns, scores, collected, bound, cutoff = (x[left] for x in (rows, columns, scores, collected, bound, cutoff))
    order = np.lexsort((ids[columns], -scores, rows))
    rows, found, scores = rows[order], ids[columns[order]], scores[order].astype(np.int64)
    best = np.arange(len(rows)) - np.searchsorted(rows, rows) < count
    return rows[best], found[best], scores[best], work


def top_k(vectors, k=5, every=50, scale=256, id_col="vec_id", vector_col="embedding", multiplied=None):
    """``query_id, rank, vec_id, score``: the ``k`` best of all vectors for each whose id ``every`` divides.

    ``multiplied`` is an accumulator for the components multiplied in all phases; a task that is run again adds again.
    """
    rows = stored(quantized(vectors, id_col, vector_col, scale))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    n_queries, n_rows = queries.count(), rows.count()
    query_blocks, vector_blocks = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_rows // VECTOR_BLOCK))
    of_query = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb")
    of_vector = F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(vector_blocks)).cast("int").alias("vb")
    every_query = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")
    every_vector = F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1))).alias("vb")
    no_reach = F.lit(-(1 << 52))
    no_bound = F.lit(None).cast("long").alias("bound")
    others = rows.select("vec_id", "v", no_bound, F.lit(False).alias("is_query"), every_query, of_vector)

    def met(asked, phase, every_block=1):
        asked = asked.select("vec_id", "v", "bound", F.lit(True).alias("is_query"), of_query, every_vector)
        return asked.unionByName(others).filter(F.col("vb") % every_block == 0).groupBy("qb", "vb").applyInPandas(
            block_pair(phase, k, multiplied), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a repeated id asks once, with the least of its vectors; as a candidate each of its rows counts
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    seen = met(asked.withColumn("bound", F.lit(None).cast("long")), gather, GATHERED)
    ranked = seen.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    # fewer than k candidates gathered: no bound
    bounds = ranked.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    bounds = bounds.select("query_id", F.when(F.col("n") == k, F.col("least")).alias("bound"))
    bounded = asked.join(bounds, asked["vec_id"] == bounds["query_id"], "left").select(
        "vec_id", "v", F.coalesce("bound", no_reach).alias("bound"))
    exact = met(bounded, resolve)
    return exact.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
