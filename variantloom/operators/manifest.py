"""Batching, file lookup and caller pairing over the manifest."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.sources.gvcf import base_name

# Lines per numbering bucket: bounds both the rows one window task sorts and the bucket table.
_BUCKET = 65_536


def number_rows(df, order_col="line"):
    """Add ``rn`` (1-based rank by the integer ``order_col``, unique) and ``total``.

    A plain ``row_number`` over everything would pull all rows into one task. Here rows are ranked
    inside buckets of consecutive numbers; only the bucket sizes, one row per bucket, see a global
    window, and their running sum is joined back.
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(order_col) / F.lit(_BUCKET)))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = (
        bucketed.groupBy("_bucket").count()
        .select("_bucket", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("_before"),
                F.sum("count").over(whole).alias("total"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(order_col))
    return (
        bucketed.withColumn("_inside", inside).join(sizes, "_bucket")
        .withColumn("rn", F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_before", "_inside")
    )


def assign_batches(manifest, size=64, order_col="line", max_batches=-1):
    """Consecutive batches of ``size`` rows, the last one shorter; optionally only the first ones."""
    batched = number_rows(manifest, order_col).withColumn(
        "batch", F.floor((F.col("rn") - 1) / F.lit(size)).cast("int")).drop("rn", "total")
    return batched if max_batches < 0 else batched.filter(F.col("batch") < max_batches)


def split_batches(samples, num_batches, start=0, order_col="line"):
    """Near-equal split into at most ``num_batches`` batches of ``ceil(total / n)`` rows, numbered from ``start``."""
    per_batch = F.ceil(F.col("total") / F.lit(num_batches))
    return number_rows(samples, order_col).withColumn(
        "batch", (F.floor((F.col("rn") - 1) / per_batch) + start).cast("int")).drop("rn", "total")


def resolve_files(manifest, staged, order_col="line"):
    """First manifest file per sample among the files staged for a batch, by exact base name.

    ``staged`` has one column ``file``.
    """
    listed = manifest.withColumn("file", base_name(F.col("Path")))
    return (
        listed.join(staged.select("file"), "file", "left_semi")
        .groupBy("sampleID").agg(F.min_by("file", order_col).alias("file"))
    )


def pair_callsets(manifest, callers=("gatk", "deepvariant"), order_col="line"):
    """One row per sample with one path per caller, the caller being a token of the path."""
    picks = [
        F.min_by("Path", F.when(F.contains("Path", F.lit(caller)), F.col(order_col))).alias(caller)
        for caller in callers
    ]
    return manifest.groupBy("sampleID").agg(*picks)
