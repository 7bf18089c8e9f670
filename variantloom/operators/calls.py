"""Calls: one row per sample and variant."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.functions.variant import allele_depth, variant_id
from variantloom.schemas import CALL_COLUMNS, VARIANT_COLUMNS


def normalize_calls(raw):
    """Call TSV rows to calls: split the allele depths, build the variant ID, fix the column order."""
    return raw.select(
        "SampleID", *VARIANT_COLUMNS, "GT", "DP", "GQ",
        allele_depth(F.col("AD"), 0).alias("REF_AD"), allele_depth(F.col("AD"), 1).alias("ALT_AD"),
        variant_id().alias("ID"),
    )


def merge_calls(*batches):
    """All batches as one table, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), [b.select(*CALL_COLUMNS) for b in batches])


def genotype_counts(calls):
    """Records per sample and genotype, with the sample's record total on every row."""
    per_genotype = calls.groupBy("SampleID", "GT").agg(F.count("*").alias("n_calls"))
    # few genotypes per sample are left, so the window sees a handful of rows per key
    total = F.sum("n_calls").over(Window.partitionBy("SampleID"))
    return per_genotype.withColumn("n_records", total)


def intersect_callers(primary, other):
    """Records of ``primary`` whose sample, position and exact alleles ``other`` has too."""
    keys = ["SampleID", *VARIANT_COLUMNS]
    return primary.join(other.select(*keys), keys, "left_semi")


def flatten_entries(matrix):
    """Matrix rows (variant with an array of entries) to calls; only het and hom-alt genotypes stay.

    Uncarried entries are filtered inside the array, before any row is made. Phase is dropped.
    """
    def carried(entry):
        alleles = entry["GT"]["alleles"]
        known = F.size(F.filter(alleles, lambda a: a.isNull())) == 0
        return alleles.isNotNull() & known & F.exists(alleles, lambda a: a > 0)

    entry = F.col("entry")
    depths = entry["AD"]
    return (
        matrix.select("locus", "alleles", F.explode(F.filter("entries", carried)).alias("entry"))
        .select(
            entry["s"].alias("SampleID"),
            F.col("locus.contig").alias("CHROM"), F.col("locus.position").alias("POS"),
            F.get("alleles", F.lit(0)).alias("REF"), F.get("alleles", F.lit(1)).alias("ALT"),
            F.array_join(F.transform(entry["GT"]["alleles"], lambda a: a.cast("string")), "/").alias("GT"),
            F.aggregate(F.filter(depths, lambda d: d.isNotNull()), F.lit(0), lambda total, d: total + d).alias("DP"),
            entry["GQ"].alias("GQ"),
            F.get(depths, F.lit(0)).alias("REF_AD"), F.get(depths, F.lit(1)).alias("ALT_AD"),
        )
        .withColumn("ID", variant_id())
    )


def sample_count(calls):
    return calls.agg(F.count_distinct("SampleID").alias("n_samples"))


def shared_calls(records, callers=("gatk", "deepvariant")):
    """Of records with ``caller, SampleID``: the first caller's records that the second one has for the same sample."""
    first, second = (records.filter(F.col("caller") == c).drop("caller") for c in callers)
    return intersect_callers(first, second)
