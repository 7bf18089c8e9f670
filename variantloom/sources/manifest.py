"""Manifest of samples and their call files."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.schemas import MANIFEST


def read_manifest(spark, path):
    """``sampleID, Path`` plus ``line``, a number that rises in file order.

    ``line`` is consecutive inside a file split; a gzip file is one split.
    """
    return (
        spark.read.schema(MANIFEST).option("sep", "\t").option("header", True).csv(path)
        .select(F.trim("sampleID").alias("sampleID"), F.trim("Path").alias("Path"),
                F.monotonically_increasing_id().alias("line"))
    )


def read_sample_list(spark, path):
    """Header-less list of sample names, one per line, with ``line`` as in :func:`read_manifest`."""
    return (
        spark.read.text(path)
        .select(F.trim("value").alias("sampleID"), F.monotonically_increasing_id().alias("line"))
        .filter(F.col("sampleID") != "")
    )
