"""A cohort's stored sets: sample numbers, carriers by variant and samples by chromosome, a folder for each batch."""

from __future__ import annotations

from variantloom.functions.text import literal_path
from variantloom.sinks.batches import batch_folder, committed_batches

_MEMBERS = "bucket bigint, few array<int>, bits binary"
SCHEMAS = {
    "numbers": "SampleID string, number bigint",
    "carriers": f"CHROM string, POS int, REF string, ALT string, {_MEMBERS}",
    "samples": f"CHROM string, {_MEMBERS}",
}


def write_sets(sets, cohort, kind, batch):
    """Write a batch's part, or write it anew; carriers are clustered by coordinate."""
    if kind == "carriers":
        sets = sets.repartitionByRange("CHROM", "POS").sortWithinPartitions("CHROM", "POS", "REF", "ALT")
    sets.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(batch_folder(f"{cohort}/{kind}", batch))


def read_sets(spark, cohort, kind):
    """All complete batches of a kind; none gives no rows."""
    folder = f"{cohort}/{kind}"
    paths = [literal_path(batch_folder(folder, name)) for name in committed_batches(spark, folder)]
    return spark.read.schema(SCHEMAS[kind]).parquet(*paths) if paths else spark.createDataFrame([], SCHEMAS[kind])
