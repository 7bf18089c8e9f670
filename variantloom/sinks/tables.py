"""Parquet tables. One write per table.

Rows are brought together with a rebalance: one shuffle, no sampling pass over the input, and adaptive
execution cuts partitions that grow too big (one common variant) and joins small ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

BIN_BP = 1_000_000


def _by_coordinate(df, *then):
    """Rows of the same stretch of a chromosome together and sorted, so row groups can be skipped by POS."""
    stretch = F.floor(F.col("POS") / BIN_BP)
    gathered = df.withColumn("_stretch", stretch).hint("rebalance", F.col("CHROM"), F.col("_stretch")).drop("_stretch")
    return gathered.sortWithinPartitions("CHROM", "POS", "REF", "ALT", *then)


def write_calls(calls, path, mode="overwrite"):
    """Calls table partitioned by CHROM, clustered by coordinate."""
    _by_coordinate(calls, "SampleID").write.mode(mode).partitionBy("CHROM").parquet(path)


def append_calls(calls, path):
    """Add one batch as it comes; the clustering is done when batches are merged."""
    calls.write.mode("append").parquet(path)


def write_annotation_table(annotation, path, mode="overwrite"):
    """Annotation table partitioned by Chr."""
    annotation.hint("rebalance", F.col("Chr")).sortWithinPartitions("Chr", "ID", "Feature").write.mode(mode).partitionBy(
        "Chr").parquet(path)


def write_unfiltered(unfiltered, path, mode="overwrite"):
    """Unfiltered table partitioned by CHROM, clustered by coordinate.

    Straight from the join every task would write a file for every contig, with positions of the whole contig in each.
    One more shuffle bounds the files by the size of the data and lets later jobs skip row groups. Rows of a variant
    and transcript lie together, so the annotation columns, which repeat for every carrier, compress to almost nothing.
    """
    _by_coordinate(unfiltered, "Feature", "SampleID").write.mode(mode).partitionBy("CHROM").parquet(path)


def write_curated(curated, path, mode="overwrite"):
    """Curated table partitioned by CHROM, clustered by coordinate."""
    _by_coordinate(curated, "SampleID", "Feature").write.mode(mode).partitionBy("CHROM").parquet(path)


def write_plain(df, path, mode="overwrite"):
    df.write.mode(mode).parquet(path)


def write_report(report, path, mode="overwrite"):
    """Funnel report as text, one folder, ordered by chromosome; a row per chromosome and metric."""
    line = F.concat_ws("\t", "CHROM", "stage", "metric", F.col("value").cast("string"))
    # one row per contig and metric, so a single file is small whatever the cohort
    report.orderBy("CHROM", "step", "metric").select(line.alias("value")).coalesce(1).write.mode(mode).text(path)
