"""Whole flows. From calls and annotations straight to results, without storing the table between."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.variant import is_damaging, max_splice_delta, variant_type
from variantloom.operators import curate as C
from variantloom.operators.integrate import annotate_calls, annotated_calls, integrate
from variantloom.schemas import CURATED_COLUMNS, PLUGINS, VARIANT_COLUMNS, VARIANT_TYPES
from variantloom.session import stored


def unfiltered(calls, tables, strict_key=False):
    """Calls with all annotations. ``tables`` maps ``default`` and each plugin to its annotation table."""
    return annotate_calls(calls, integrate(tables["default"], [tables[p] for p in PLUGINS if p in tables], strict_key))


def _passing(calls, contigs, thresholds):
    """Calls that pass quality control; without one of its coordinates a call has no frequency."""
    return C.qc_filter(C.on_contigs(calls, contigs), **C._pick(thresholds, C._QC)).dropna(subset=VARIANT_COLUMNS)


def _with_frequency(wanted, calls, annotations, denominator, contigs, thresholds):
    """Annotation rows ``wanted`` with ``n_samples, dataset_AF`` of their variants, and ``_calls``: rows that pass quality control.

    Counts are made by ID, so that their join takes them as the aggregation leaves them. Relies on IDs made by ``normalize_calls``.
    """
    counts = C.sliced_counts(annotated_calls(calls, annotations), denominator, contigs)
    carriers = _passing(calls, contigs, thresholds).groupBy("CHROM", "ID").agg(
        F.count_distinct("SampleID").alias("_carriers"), F.count("*").alias("_calls"))
    wanted = C.on_contigs(wanted, contigs, "Chr").withColumnRenamed("Chr", "CHROM")
    return C.with_counts(wanted.join(carriers, ["CHROM", "ID"]), counts, contigs).withColumn(
        "dataset_AF", F.try_divide(F.col("_carriers"), F.lit(2) * F.col("n_samples")))


def _rare_rows(wanted, calls, annotations, max_af, min_samples, denominator, contigs, thresholds):
    """Passing calls joined, once, with those of their ``wanted`` annotation rows that are rare inside the cohort too."""
    rare = _with_frequency(wanted, calls, annotations, denominator, contigs, thresholds).filter(C.is_rare(max_af, min_samples))
    return annotate_calls(_passing(calls, contigs, thresholds), rare.drop("_carriers", "_calls").withColumnRenamed("CHROM", "Chr"))


def _outside(annotations, max_af):
    """Annotation rows that are rare outside the cohort, with class and highest splice delta."""
    return annotations.filter(F.col("gnomAD_max_AF") <= max_af).withColumns(
        {"Variant_Type": variant_type(), "Max_DS_SpliceAI": max_splice_delta()})


def curated_cohort(calls, annotations, max_af=C.MAX_AF, min_samples=C.MIN_SAMPLES, denominator="chromosome",
                   contigs=None, **thresholds):
    """The curated table from calls and integrated annotations; same rows as ``curate(unfiltered(...))``.

    Call quality depends on the call, class and impact on the annotation, frequency on the variant.
    So annotations are filtered, given their cohort frequency and filtered again for rarity before
    the calls are joined, once, with the few that are left.
    """
    wanted = _outside(annotations, max_af).filter(is_damaging(**C._pick(thresholds, C._IMPACT)))
    return _rare_rows(wanted, calls, annotations, max_af, min_samples, denominator, contigs, thresholds).select(*CURATED_COLUMNS)


def rare_cohort(calls, annotations, max_af=C.MAX_AF, min_samples=C.MIN_SAMPLES, denominator="chromosome",
                contigs=None, **thresholds):
    """Rare rows of any impact, classified; same rows as ``classify(rare_filter(...))`` over the unfiltered table."""
    return _rare_rows(_outside(annotations, max_af), calls, annotations, max_af, min_samples, denominator, contigs, thresholds)


def _class_counts(calls, annotations, column, max_af, min_samples, denominator, contigs, thresholds, keep=None):
    """Rare rows per chromosome and class, before and after the impact filter.

    Every passing call of a variant meets each of its annotation rows, so an annotation row counts as many rows as its
    variant has such calls; call rows never meet annotation rows.
    """
    wanted = _outside(annotations, max_af)
    if keep is not None:
        wanted = wanted.filter(keep)
    damaging = F.coalesce(is_damaging(**C._pick(thresholds, C._IMPACT)), F.lit(False))
    wanted = wanted.select("Chr", "ID", column, damaging.alias("_damaging"))
    rows = _with_frequency(wanted, calls, annotations, denominator, contigs, thresholds).filter(C._inside(max_af, min_samples))
    return rows.groupBy("CHROM", column).agg(
        F.sum("_calls").alias("before"), F.sum(F.when(F.col("_damaging"), F.col("_calls")).otherwise(0)).alias("after"))


def cohort_type_counts(calls, annotations, damaging_only=False, max_af=C.MAX_AF, min_samples=C.MIN_SAMPLES,
                       denominator="chromosome", contigs=None, **thresholds):
    """Same rows as ``variant_type_counts(unfiltered(...))``."""
    counts = _class_counts(calls, annotations, "Variant_Type", max_af, min_samples, denominator, contigs, thresholds)
    n = F.col("after" if damaging_only else "before")
    return counts.select("CHROM", "Variant_Type", n.alias("n")).filter(F.col("n") > 0)


def cohort_other_consequences(calls, annotations, max_af=C.MAX_AF, min_samples=C.MIN_SAMPLES, denominator="chromosome",
                              contigs=None, **thresholds):
    """Same rows as ``other_consequences(unfiltered(...))``."""
    counts = _class_counts(calls, annotations, "Consequence", max_af, min_samples, denominator, contigs, thresholds,
                           keep=F.col("Variant_Type") == "Other")
    return counts.select("CHROM", "Consequence", F.col("before").alias("n")).orderBy("CHROM", F.desc("n"), "Consequence")


def cohort_funnel(calls, annotations, max_af=C.MAX_AF, min_samples=C.MIN_SAMPLES, denominator="chromosome",
                  contigs=None, **thresholds):
    """The funnel from calls and integrated annotations; same rows as ``curation_funnel(unfiltered(...))``.

    A variant's annotation rows are the same for every carrier, so row counts are products of a
    per-variant call count and a per-variant annotation count. Calls are read twice and shuffled as
    partial counts; they never meet the annotation rows.
    """
    # read by totals and by samples: stored, or each would count all annotated calls for itself
    counts = stored(C.sliced_counts(annotated_calls(calls, annotations), denominator, contigs), "counts")
    calls = C.on_contigs(calls, contigs)
    annotations = C.on_contigs(annotations, contigs, "Chr")
    qc = C.passes_qc(**C._pick(thresholds, C._QC))
    per_pair = calls.groupBy("CHROM", "ID", "SampleID").agg(F.count_if(qc).alias("rows_qc"))
    per_variant = per_pair.groupBy("CHROM", "ID").agg(
        F.count("SampleID").alias("pairs"), F.sum("rows_qc").alias("rows_qc"),
        F.count_if((F.col("rows_qc") > 0) & F.col("SampleID").isNotNull()).alias("pairs_qc"))
    # one row per annotated variant: how many of its annotation rows fall in each class
    outside = F.coalesce(F.col("gnomAD_max_AF") <= max_af, F.lit(False))
    typed = annotations.withColumns({"Variant_Type": variant_type(), "Max_DS_SpliceAI": max_splice_delta()})
    damaging = F.coalesce(is_damaging(**C._pick(thresholds, C._IMPACT)), F.lit(False))
    of_class = [(t, F.col("Variant_Type") == t) for t in VARIANT_TYPES]
    per_annotation = typed.groupBy(F.col("Chr").alias("CHROM"), "ID").agg(
        *[F.count_if(outside & is_class).alias(f"before_{t}") for t, is_class in of_class],
        *[F.count_if(outside & damaging & is_class).alias(f"after_{t}") for t, is_class in of_class],
        F.max(outside).alias("_outside"))
    samples = counts if denominator == "chromosome" else C.sample_counts(annotated_calls(calls, annotations))
    joined = C.with_counts(per_annotation.join(per_variant, ["CHROM", "ID"]), counts, contigs).withColumn(
        "dataset_AF", F.try_divide(F.col("pairs_qc"), F.lit(2) * F.col("n_samples")))
    inside = C._inside(max_af, min_samples)

    def rows(column):
        return F.sum(F.when(inside, F.col("rows_qc") * F.col(column)).otherwise(0)).alias(column)

    totals = joined.groupBy("CHROM").agg(
        F.count("*").alias("variants"), F.sum("pairs").alias("pairs"), F.sum("pairs_qc").alias("pairs_after_qc"),
        F.sum(F.when(inside & F.col("_outside"), F.col("pairs_qc")).otherwise(0)).alias("pairs_after_rare"),
        F.max(F.col("n_samples") >= min_samples).alias("_inside_applied"),
        *[rows(f"{side}_{t}") for side in ("before", "after") for t in VARIANT_TYPES])
    return C.funnel_rows(samples, totals)
