"""Embedding near-duplicates through a pivot-permutation index.

Pivots are vectors of a bounded sample, thinned so that no two lie within the link radius of each other: a
group of near copies, however large, has one pivot or a few, and its members agree on their nearest ones. Each vector is described by its nearest pivots in order, and
listed under each of them. Two vectors are candidates if they share at least ``shared`` of these
pivots, which is counted inside the inverted lists; candidates are verified by their cosine in double
precision. Lists are met cell by cell, so no list is held whole and no pair of vectors becomes a row. A
pair on several lists counts on the list of the lowest pivot that both share.

The number of pivots grows with the square root of the table up to ``most_pivots``, which bounds the
pivots that are broadcast. Every vector is indexed. Equal vectors are one node of the index.

Vectors that are null, empty or zero, that hold nulls or values that are not finite, or that differ in
length from most vectors link with nothing: they have no links and are their own component. Repeated
rows are vectors of their own and link with each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from variantloom.llm.common import stored
from variantloom.llm.components import cells, components, roots

NEAREST = 8
SHARED = 2
BLOCK = 2048
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096


def sound(column):
    """The vector has components, all of them finite numbers, one of them not zero."""
    values = F.col(column)
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(values) > 0) & finite & F.exists(values, lambda x: x != 0), F.lit(False))


def usual_length(vectors):
    """Length that most sound vectors have; the larger of two equally frequent ones; null if there are none."""
    row = (vectors.filter("sound").groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("length")).limit(1).first())
    return row["length"] if row else None


def unit(rows):
    """Rows scaled to length one in double precision, large and small values alike."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest_pivots(pivots, count):
    """Function of batches of ``rep, copies, vector``: adds the sorted numbers of the nearest pivots."""
    def run(source):
        for frame in source:
            for at in range(0, len(frame), 1024):
                part = frame.iloc[at:at + 1024]
                likeness = unit(np.stack(part["vector"].to_numpy())) @ pivots.T
                order = np.argsort(-likeness, axis=1, kind="stable")[:, :count]
                yield part.assign(described=list(order.astype(np.int32)))

    return run


def listed_links(least, shared):
    """Function of one cell of one pivot's list: links of each member, and the first one it is connected with."""
    def links(key, cell):
        pivot, left, right = key
        cell = cell.sort_values(["rep", "own"]).drop_duplicates("rep")
        x = unit(np.stack(cell["vector"].to_numpy()))
        described = np.stack(cell["described"].to_numpy())
        present, column = np.unique(described, return_inverse=True)
        member = np.zeros((len(cell), len(present)), np.float32)
        member[np.arange(len(cell))[:, None], column.reshape(described.shape)] = 1
        lower = int(np.searchsorted(present, pivot))
        own = cell["own"].to_numpy()
        linked = np.empty((len(cell), len(cell)), bool)
        for at in range(0, len(cell), 256):
            part = slice(at, at + 256)
            candidates = member[part] @ member.T >= shared
            candidates &= member[part, :lower] @ member[:, :lower].T < 1
            if left != right:
                candidates &= own[part, None] != own[None, :]
            linked[part] = candidates & (x[part] @ x.T >= least) if candidates.any() else False
        np.fill_diagonal(linked, False)
        reps = cell["rep"].to_numpy()
        counted = linked @ cell["copies"].to_numpy().astype(np.float64)
        any_link = linked.any(axis=1)
        return pd.DataFrame({"a": reps, "b": reps[roots(linked)], "links": counted.astype(np.int64)})[any_link]

    return links


def thinned(candidates, count, apart):
    """The first ``count`` of the unit vectors whose cosine with every one taken before them is below ``apart``."""
    taken, held = np.empty((min(count, len(candidates)), candidates.shape[1])), 0
    for candidate in candidates:
        if held == len(taken):
            break
        if not held or (taken[:held] @ candidate).max() < apart:
            taken[held] = candidate
            held += 1
    return taken[:held]


def pivot_sample(reps, count, least):
    """At most ``count`` pivots out of the first vectors by the hash of their contents, the same on every run.

    Twice the squared distance of a link lies between any two of them at least.
    """
    rows = reps.orderBy(F.xxhash64("vector"), "rep").limit(2 * count).select("vector").collect()
    return thinned(unit([r["vector"] for r in rows]), count, 2 * least - 1)


def near_duplicates(vectors, least=0.95, id_col="vec_id", vector_col="embedding", nearest=NEAREST, shared=SHARED,
                    block=BLOCK, pivots=None):
    """``vec_id, n_links, component_id, kept`` of every row; links at a cosine of ``least`` or more.

    ``pivots``: their number; by default it follows from the number of vectors. Thinning may leave fewer. If it leaves
    fewer than ``shared``, all of them have to be shared, and all pairs are candidates.
    """
    spark = vectors.sparkSession
    all_rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                              F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    all_rows = all_rows.withColumn("sound", sound("vector"))
    length = usual_length(all_rows)
    fits = F.col("sound") & (F.size("vector") == F.lit(length if length is not None else -1))
    all_rows = all_rows.select("vec_id", "vector", fits.alias("fits"), F.xxhash64("vector").alias("h1"),
                               F.xxhash64(F.lit(1), F.reverse("vector")).alias("h2"))
    reps = (all_rows.filter("fits").groupBy("h1", "h2")
            .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
            .withColumn("rep", F.monotonically_increasing_id()))
    reps = stored(reps)
    rows = reps.count()
    wanted = pivots or int(min(MOST_PIVOTS, max(LEAST_PIVOTS, 2 * rows ** 0.5)))
    if rows:
        at = spark.sparkContext.broadcast(pivot_sample(reps, wanted, least))
        shared = min(shared, len(at.value))
        described = stored(reps.select("rep", "copies", "vector").mapInPandas(
            lambda source: nearest_pivots(at.value, nearest)(source),
            "rep long, copies long, vector array<double>, described array<int>"))
        listed = described.select("*", F.explode("described").alias("pivot"))
        sizes = described.select(F.explode("described").alias("pivot")).groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
        # one row for each pivot: bounded by most_pivots
        members = listed.join(F.broadcast(sizes), "pivot").filter("members > 1")
        found = stored(cells(members, "pivot", "rep", "members", block).groupBy("pivot", "left", "right")
                       .applyInPandas(listed_links(least, shared), "a long, b long, links long"))
    else:
        found = spark.createDataFrame([], "a long, b long, links long")
    linked = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    groups = components(found.select("a", "b"))
    named = (reps.drop("vector").join(linked, "rep", "left")
             .join(groups, reps["rep"] == groups["node"], "left")
             .select("h1", "h2", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("component", "rep").alias("component")))
    least_ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least_ids, "component").select("h1", "h2", "copies", "links", "component_id")
    out = all_rows.drop("vector").join(named.withColumn("fits", F.lit(True)), ["h1", "h2", "fits"], "left")
    component = F.when(F.col("fits") & F.col("copies").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
