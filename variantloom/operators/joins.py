"""Equi-join whose hot keys adaptive execution can split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F


def splittable_join(left, right, keys, how="inner", made=None):
    """Join on ``keys``, many rows per key on the left, few on the right.

    Adaptive execution splits a skewed partition only when both inputs come straight from a shuffle.
    A side already grouped by ``keys`` would be joined as it is, and one variant's carriers would end
    in one task. A further key computed from the others changes no match but asks for a fresh shuffle
    of both sides; that costs the small side once more and keeps the large side splittable. It is compared as an
    expression: no row carries it through the shuffle. ``made`` has expressions for keys that the left side is to do without in the same way.
    """
    made = made or {}
    ours, theirs = [made.get(k, F.col(k)) for k in keys], [F.col(f"_right_{k}") for k in keys]
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    # the hash first: a sort tells nearly all rows apart by it, without making the other keys for every comparison
    same = reduce(lambda a, b: a & b, [a == b for a, b in zip([F.xxhash64(*ours), *ours], [F.xxhash64(*theirs), *theirs])])
    joined = left.join(right, same, how)
    payload = [] if how == "left_semi" else [c for c in right.columns if not c.startswith("_right_")]
    return joined.select(*[a.alias(k) for a, k in zip(ours, keys)], *[c for c in left.columns if c not in keys], *payload)
