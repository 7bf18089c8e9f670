"""Record filters, allele split and the distinct variants of a cohort."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.variant import allele_class, genotype_for_allele, variant_id
from variantloom.schemas import CANONICAL_CONTIGS, UNCALLED_GENOTYPES, VARIANT_COLUMNS


def split_alleles(records):
    """One row per ALT. GT is recoded, AD becomes ``ref,alt``; other columns are copied."""
    alts = F.split("ALT", ",")
    n_alts = F.col("_n_alts")
    depths = F.split("AD", ",")
    columns = [c for c in records.columns if c not in ("ALT", "GT", "AD")]
    exploded = records.select("*", F.size(alts).alias("_n_alts"), F.posexplode(alts).alias("_at", "_alt"))
    number = F.col("_at") + 1
    return exploded.select(
        *columns,
        F.col("_alt").alias("ALT"),
        F.when(n_alts == 1, F.col("GT")).otherwise(genotype_for_allele(F.col("GT"), number)).alias("GT"),
        F.when((n_alts == 1) | (F.size(depths) != n_alts + 1), F.col("AD"))
        .otherwise(F.concat_ws(",", F.get(depths, F.lit(0)), F.get(depths, number))).alias("AD"),
    ).select(*records.columns)


def site_filter(records, contigs=CANONICAL_CONTIGS):
    """SNV and indel records with a called genotype and complete DP, AD and GQ.

    ``contigs=None`` keeps every contig.
    """
    def given(column):
        return F.col(column).isNotNull() & (F.col(column) != ".")

    kept = records.filter(
        ~F.col("GT").isin(UNCALLED_GENOTYPES) & given("DP") & given("GQ") & given("AD")
        & ~F.array_contains(F.split("AD", ","), ".")
    )
    if contigs is not None:
        kept = kept.filter(F.col("CHROM").isin(list(contigs)))
    return kept.filter(allele_class(F.col("REF"), F.col("ALT")).isin("snv", "indel"))


def extract_calls(records, contigs=CANONICAL_CONTIGS):
    """Parsed gVCF records to call TSV rows: split, filter, numbers.

    What a record already decides for all its alleles goes before the split: recoding leaves 0 and missing alleles as
    they are, so a genotype without a call has none for any allele.
    """
    complete = records.filter(
        ~F.col("GT").isin(UNCALLED_GENOTYPES) & F.col("AD").isNotNull() & (F.col("AD") != "."))
    kept = site_filter(split_alleles(complete), contigs)
    return kept.withColumns({"DP": F.col("DP").try_cast("int"), "GQ": F.col("GQ").try_cast("int")})


def unique_variants(calls):
    """Distinct variants with their ID.

    The ID is a function of the four coordinates, so it is left out of the shuffle (and of the scan)
    and built afterwards on the distinct rows.
    """
    return calls.select(*VARIANT_COLUMNS).distinct().select(variant_id().alias("ID"), *VARIANT_COLUMNS)


def variants_per_chrom(variants):
    """Distinct variants per chromosome in name order, then the total as ``all``."""
    counts = variants.groupBy("CHROM").agg(F.count("*").alias("n"))
    return (
        counts.rollup("CHROM").agg(F.sum("n").alias("n_variants"), F.grouping("CHROM").alias("_all"))
        .orderBy("_all", "CHROM")
        .select(F.when(F.col("_all") == 1, "all").otherwise(F.col("CHROM")).alias("CHROM"), "n_variants")
    )


def vcf_rows(calls):
    """Eight-column sites rows of the distinct variants."""
    return unique_variants(calls).select(
        "CHROM", "POS", "ID", "REF", "ALT",
        F.lit(".").alias("QUAL"), F.lit("PASS").alias("FILTER"), F.lit(".").alias("INFO"),
    )
