"""op13: clusters equal a plain full scan in Python integers; edges of the input."""

import hashlib
import math
import random

import numpy as np
import pytest

from variantloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, clusters=16, rounds=3):
    kept = []
    for vec_id, x, _ in rows:
        if x is not None and len(x) == 64 and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [math.floor(64 * float(np.float32(c))) for c in x]))
    hashed = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    places = [v for _, v in hashed[:clusters]]
    for r in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(places)) for _, v in kept]
        if r < rounds:
            for k in range(len(places)):
                mine = [v for (_, v), (_, own) in zip(kept, near) if own == k]
                if mine:
                    places[k] = [sum(column) // len(mine) for column in zip(*mine)]
    inertia = [sum(d for d, own in near if own == k) for k in range(len(places))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return sorted(((i, k, d, inertia[k], sum(inertia), digests[k]) for (i, _), (d, k) in zip(kept, near)), key=str)


def result(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, centroids.cluster(table, **options).collect()), key=str)


def vectors(n, seed, near=0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(64)], 0) for i in range(n)]
    hot = [rng.gauss(0, 0.3) for _ in range(64)]
    return rows + [(n + i, [c + rng.gauss(0, 0.02) for c in hot], 1) for i in range(near)]


@pytest.mark.parametrize("near", [0, 60])
def test_equals_a_full_scan(spark, near):
    rows = vectors(120, 3, near)
    assert result(spark, rows) == brute(rows)


def test_more_rounds_equal_a_full_scan(spark):
    rows = vectors(90, 5)
    assert result(spark, rows, clusters=5, rounds=6) == brute(rows, 5, 6)


def test_ties_repeats_nulls_and_other_lengths(spark):
    zero, one = [0.0] * 64, [1.0] + [0.0] * 63
    rows = [(1, zero, 0), (1, zero, 0), (1, one, None), (2, one, 0), (3, [0.5] + [0.0] * 63, 0), (None, one, 0), (4, None, 0),
            (5, [0.1] * 63, 0), (6, [float("nan")] * 64, 0), (7, [float("inf")] + zero[1:], 0), (8, [None] + zero[1:], 0), (9, [], 0)]
    assert result(spark, rows) == brute(rows)


def test_empty_and_fewer_vectors_than_clusters(spark):
    assert result(spark, []) == []
    assert result(spark, [(4, None, 0)]) == []
    rows = vectors(3, 1)
    assert result(spark, rows) == brute(rows)


def test_clashing_columns_do_not_matter(spark):
    rows = vectors(20, 2)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS cluster", "2 AS far", "3 AS v", "4 AS distance", "5 AS k1")
    assert sorted(map(tuple, centroids.cluster(table).collect()), key=str) == brute(rows)


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="too large"):
        result(spark, [(1, [3e6] * 64, 0)])


def test_bounds_skip_distances_and_use_the_total_displacement(spark):
    rows = spark.createDataFrame(vectors(400, 9, 200), SCHEMA)
    state, _ = centroids.assigned(rows)
    assert state.agg({"computed": "avg"}).first()[0] < 14
    # a centroid that went away and came back: its stored distance is good again
    there, away = np.zeros((2, 64), np.int64), np.zeros((2, 64), np.int64)
    there[1, 0], away[1, 0] = 100, 5
    assert centroids.displacements([there, away, there])[0].tolist() == [0, 0]
    own, distance, far, seen, computed = centroids.assign(np.zeros((1, 64), np.int64), np.zeros(1, np.int32), np.array([[0, 100]], np.float32),
                                                          np.zeros((1, 2), np.int8), [there, away, there])
    assert (own[0], distance[0], computed[0], seen[0, 1]) == (0, 0, 1, 0)
