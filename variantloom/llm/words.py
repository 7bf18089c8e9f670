"""Words of texts, and bounded samples of rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

# Runs of word characters without digits and low lines.
WORD = re.compile(r"[^\W\d_]+")
SAMPLE_PARTS = 1 << 30


def words(text):
    return WORD.findall(text.lower())


def has_letter(text):
    return any(map(str.isalpha, text))


def bounded(rows, most, *key):
    """About ``most`` of the rows, all if they are fewer: those whose key hashes below a threshold.

    The same rows on every run; repeated keys go together.
    """
    count = rows.count()
    if count <= most:
        return rows
    below = int(SAMPLE_PARTS * (most / count))
    return rows.filter(F.pmod(F.xxhash64(F.lit(11), *key), F.lit(SAMPLE_PARTS)) < below)


def bounded_by(rows, most, group, *key):
    """As :func:`bounded`, of each value of ``group``: about ``most`` of its rows, all if they are fewer."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    below = counts.select(group, F.floor(SAMPLE_PARTS * (F.lit(most) / F.col("_n"))).alias("_below"))
    # one row for each large group
    return (rows.join(F.broadcast(below), group, "left")
            .filter(F.pmod(F.xxhash64(F.lit(11), *key), F.lit(SAMPLE_PARTS)) < F.coalesce("_below", F.lit(SAMPLE_PARTS))).drop("_below"))
