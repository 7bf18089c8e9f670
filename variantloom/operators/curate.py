"""Quality control, cohort frequency, rarity, functional class and impact; counts per stage.

Everything that depends on a variant only is worked out on one row per variant, after counts were
combined map-side. No step brings all carriers of a variant, or all rows of a chromosome, together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from variantloom.functions.variant import allele_ratio, is_damaging, max_splice_delta, variant_type
from variantloom.operators.joins import splittable_join
from variantloom.session import stored
from variantloom.schemas import CURATED_COLUMNS, VARIANT_COLUMNS, VARIANT_TYPES

MAX_AF = 0.001
MIN_SAMPLES = 5000


def passes_qc(min_dp=20, min_gq=30, min_ratio=0.2, max_ratio=0.8):
    ratio = allele_ratio()
    return (F.col("DP") >= min_dp) & (F.col("GQ") >= min_gq) & (ratio >= min_ratio) & (ratio <= max_ratio)


def qc_filter(df, min_dp=20, min_gq=30, min_ratio=0.2, max_ratio=0.8):
    """Rows passing call quality control, with ``AC_ratio``. Missing metrics or depth 0 fail."""
    return df.filter(passes_qc(min_dp, min_gq, min_ratio, max_ratio)).withColumn("AC_ratio", allele_ratio())


def sample_counts(df, denominator="chromosome"):
    """``CHROM, n_samples``: distinct samples per chromosome, or the whole cohort's on each chromosome."""
    if denominator == "chromosome":
        return df.groupBy("CHROM").agg(F.count_distinct("SampleID").alias("n_samples"))
    if denominator != "cohort":
        raise ValueError(f"unknown denominator {denominator!r}")
    whole = df.agg(F.count_distinct("SampleID").alias("n"))
    return df.select("CHROM").distinct().select("CHROM", whole.scalar().alias("n_samples"))


def on_contigs(df, contigs, column="CHROM"):
    """Rows on the listed contigs (a partition filter on stored tables); everything when none are listed."""
    return df if contigs is None else df.filter(F.col(column).isin(list(contigs)))


def sliced_counts(df, denominator, contigs):
    """Sample counts for a job on listed contigs; the cohort's size is that of the whole table all the same."""
    if denominator == "cohort":
        return on_contigs(sample_counts(df, denominator), contigs)
    return sample_counts(on_contigs(df, contigs), denominator)


def with_counts(per_variant, counts, contigs):
    """Attach ``n_samples`` to per-variant rows, on the listed contigs if there are any.

    The counts, one row per chromosome, are broadcast if adaptive execution finds them small; if not, a
    chromosome with very many variants is split.
    """
    return splittable_join(on_contigs(per_variant, contigs), on_contigs(counts, contigs), ["CHROM"])


def variant_frequencies(qc, counts, contigs=None):
    """``CHROM, POS, REF, ALT, n_samples, dataset_AF``: carriers over twice the chromosome's samples.

    A carrier counts once whatever the genotype. The distinct count is spread by sample before it is
    summed per variant, so a common variant is no hot group.
    """
    carriers = qc.groupBy(*VARIANT_COLUMNS).agg(F.count_distinct("SampleID").alias("_carriers"))
    return with_counts(carriers, counts, contigs).select(
        *VARIANT_COLUMNS, "n_samples", F.try_divide(F.col("_carriers"), F.lit(2) * F.col("n_samples")).alias("dataset_AF"))


def attach_frequencies(qc, frequencies):
    """Row-level ``dataset_AF`` (and ``n_samples``); one frequency row per variant on the right side."""
    return splittable_join(qc, frequencies, VARIANT_COLUMNS, "left")


def is_rare(max_af=MAX_AF, min_samples=MIN_SAMPLES):
    """Rare outside the cohort, and inside it too where the chromosome has enough samples."""
    return (F.col("gnomAD_max_AF") <= max_af) & (
        (F.col("n_samples") < min_samples) | (F.col("dataset_AF") <= max_af))


def rare_filter(df, max_af=MAX_AF, min_samples=MIN_SAMPLES):
    return df.filter(is_rare(max_af, min_samples))


def classify(df):
    return df.withColumn("Variant_Type", variant_type())


def impact_filter(df, min_splice=0.8, min_am=0.564):
    """Rows whose class is damaging enough, with ``Max_DS_SpliceAI``."""
    return df.withColumn("Max_DS_SpliceAI", max_splice_delta()).filter(is_damaging(min_splice, min_am))


_QC = ("min_dp", "min_gq", "min_ratio", "max_ratio")
_IMPACT = ("min_splice", "min_am")


def _pick(thresholds, names):
    return {k: v for k, v in thresholds.items() if k in names}


def curate(unfiltered, max_af=MAX_AF, min_samples=MIN_SAMPLES, denominator="chromosome", contigs=None, frequencies=None, **thresholds):
    """Unfiltered table to the 22-column curated table.

    Three column-pruned passes over the input: samples per chromosome, carriers per variant, and the
    rows; with ``frequencies`` of the whole cohort given (see :mod:`variantloom.operators.carriers`), the rows alone. Conditions on a row's own columns run before the frequency join, which then sees only
    damaging, externally rare rows.
    """
    if frequencies is None:
        frequencies = cohort_frequencies(unfiltered, denominator, contigs, **thresholds)
    qc = qc_filter(on_contigs(unfiltered, contigs), **_pick(thresholds, _QC))
    candidates = impact_filter(classify(qc.filter(F.col("gnomAD_max_AF") <= max_af)), **_pick(thresholds, _IMPACT))
    return rare_filter(attach_frequencies(candidates, frequencies), max_af, min_samples).select(*CURATED_COLUMNS)


def _rows_per_count(df, rows):
    """One row per chromosome and count. ``rows`` lists ``step, stage, metric, count`` (text or columns)."""
    made = F.array(*[
        F.struct(F.lit(step).alias("step"), F.lit(stage).alias("stage"), F.lit(metric).alias("metric"),
                 count.cast("bigint").alias("value"))
        for step, stage, metric, count in rows])
    return df.select("CHROM", F.inline(made))


def cohort_counts(df):
    """Distinct samples, variants and sample-variant pairs per chromosome, long format.

    Pairs are made distinct first; samples and variants are counted on what is left instead of
    expanding every input row once per distinct count.
    """
    pairs = df.filter(F.col("SampleID").isNotNull() & F.col("ID").isNotNull()).select("CHROM", "SampleID", "ID").distinct()
    sides = F.array(
        F.struct(F.lit("samples").alias("metric"), F.col("SampleID").alias("key")),
        F.struct(F.lit("variants").alias("metric"), F.col("ID").alias("key")))
    singles = (
        pairs.select("CHROM", F.inline(sides)).distinct()
        .groupBy("CHROM", "metric").agg(F.count("*").alias("value"))
    )
    return singles.unionByName(
        pairs.groupBy("CHROM").agg(F.count("*").alias("value")).select("CHROM", F.lit("pairs").alias("metric"), "value"))


def _stage_rows(unfiltered, max_af, **qc):
    """Unfiltered rows with ``_qc`` and ``_rare_outside`` flags as 0/1."""
    ok = F.coalesce(passes_qc(**qc), F.lit(False))
    outside = ok & F.coalesce(F.col("gnomAD_max_AF") <= max_af, F.lit(False))
    return unfiltered.withColumns({"_qc": ok.cast("int"), "_rare_outside": outside.cast("int")})


def _inside(max_af, min_samples):
    return (F.col("n_samples") < min_samples) | (F.col("dataset_AF") <= max_af)


def _rows_per_class(unfiltered, frequencies, column, max_af, min_samples, keep=None, **thresholds):
    """Rare rows per chromosome and class, before and after the impact filter.

    Rows are counted per variant and class first; the cohort frequency then joins one row per variant.
    """
    qc = qc_filter(unfiltered, **_pick(thresholds, _QC)).filter(F.col("gnomAD_max_AF") <= max_af)
    rows = classify(qc).withColumn("Max_DS_SpliceAI", max_splice_delta())
    if keep is not None:
        rows = rows.filter(keep)
    per_variant = rows.groupBy(*VARIANT_COLUMNS, column).agg(
        F.count("*").alias("before"), F.count_if(is_damaging(**_pick(thresholds, _IMPACT))).alias("after"))
    return (
        attach_frequencies(per_variant, frequencies).filter(_inside(max_af, min_samples))
        .groupBy("CHROM", column).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    )


def cohort_frequencies(unfiltered, denominator="chromosome", contigs=None, **thresholds):
    """Frequencies of the variants that pass quality control. Stored, they serve every result of the same table."""
    counts = sliced_counts(unfiltered, denominator, contigs)
    return variant_frequencies(qc_filter(on_contigs(unfiltered, contigs), **_pick(thresholds, _QC)), counts, contigs)


def _class_counts(unfiltered, column, max_af, min_samples, denominator, contigs, keep=None, frequencies=None, **thresholds):
    if frequencies is None:
        frequencies = cohort_frequencies(unfiltered, denominator, contigs, **thresholds)
    return _rows_per_class(on_contigs(unfiltered, contigs), frequencies, column, max_af, min_samples, keep, **thresholds)


def variant_type_counts(unfiltered, damaging_only=False, max_af=MAX_AF, min_samples=MIN_SAMPLES,
                        denominator="chromosome", contigs=None, **thresholds):
    """``CHROM, Variant_Type, n``: rows after the rare filter, or after the impact filter as well."""
    counts = _class_counts(unfiltered, "Variant_Type", max_af, min_samples, denominator, contigs, **thresholds)
    n = F.col("after" if damaging_only else "before")
    return counts.select("CHROM", "Variant_Type", n.alias("n")).filter(F.col("n") > 0)


def other_consequences(unfiltered, max_af=MAX_AF, min_samples=MIN_SAMPLES, denominator="chromosome", contigs=None,
                       **thresholds):
    """Consequences inside class ``Other``, most frequent first within a chromosome."""
    counts = _class_counts(unfiltered, "Consequence", max_af, min_samples, denominator, contigs,
                           keep=F.col("Variant_Type") == "Other", **thresholds)
    return counts.select("CHROM", "Consequence", F.col("before").alias("n")).orderBy("CHROM", F.desc("n"), "Consequence")


def funnel_rows(samples, totals, types=None):
    """Funnel in long format from its aggregates.

    Class counts come as ``types`` (one row per chromosome and class) or as columns ``before_<class>``
    and ``after_<class>`` of ``totals``. Classes without rows are left out. The rare stage names the
    filters that ran on the chromosome.
    """
    rare = F.when(F.col("_inside_applied"), "rare: gnomAD_max_AF and dataset_AF").otherwise("rare: gnomAD_max_AF")
    stages = [(4, "variant types before impact filter", "before"), (5, "variant types after impact filter", "after")]
    counts = [
        (1, "input", "variants", F.col("variants")), (1, "input", "pairs", F.col("pairs")),
        (2, "qc", "pairs", F.col("pairs_after_qc")), (3, rare, "pairs", F.col("pairs_after_rare"))]
    if types is None:
        counts += [(n, stage, t, F.nullif(F.col(f"{side}_{t}"), F.lit(0))) for n, stage, side in stages for t in VARIANT_TYPES]
    parts = [_rows_per_count(samples, [(1, "input", "samples", F.col("n_samples"))]),
             _rows_per_count(totals, counts).filter(F.col("value").isNotNull())]
    if types is not None:
        parts.append(_rows_per_count(types, [
            (n, stage, F.col("Variant_Type"), F.nullif(F.col(side), F.lit(0))) for n, stage, side in stages
        ]).filter(F.col("value").isNotNull()))
    return reduce(lambda a, b: a.unionByName(b), parts)


def curation_funnel(unfiltered, max_af=MAX_AF, min_samples=MIN_SAMPLES, denominator="chromosome", contigs=None,
                    frequencies=None, **thresholds):
    """``CHROM, step, stage, metric, value`` for every stage of the curation.

    Pair counts for all three stages come from one aggregation per sample and variant, folded to one
    row per variant; rarity is decided there. Class counts take ``frequencies`` of the same table where they are
    given, so that the aggregation is in the plan once.
    """
    qc_args = _pick(thresholds, _QC)
    # a row for each chromosome, read by totals and by samples
    counts = stored(sliced_counts(unfiltered, denominator, contigs), "counts")
    unfiltered = on_contigs(unfiltered, contigs)
    samples = counts if denominator == "chromosome" else sample_counts(unfiltered)
    flagged = _stage_rows(unfiltered, max_af, **qc_args).filter(F.col("SampleID").isNotNull() & F.col("ID").isNotNull())
    per_pair = flagged.groupBy(*VARIANT_COLUMNS, "ID", "SampleID").agg(
        F.max("_qc").alias("_qc"), F.max("_rare_outside").alias("_rare_outside"))
    per_variant = per_pair.groupBy(*VARIANT_COLUMNS, "ID").agg(
        F.count("*").alias("pairs"), F.sum("_qc").alias("pairs_qc"), F.sum("_rare_outside").alias("pairs_outside"))
    counted = with_counts(per_variant, counts, contigs).withColumn(
        "dataset_AF", F.try_divide(F.col("pairs_qc"), F.lit(2) * F.col("n_samples")))
    if frequencies is None:
        # read by totals and by classes: stored, or each would aggregate all pairs for itself
        counted = stored(counted, "variants")
        frequencies = counted.select(*VARIANT_COLUMNS, "n_samples", "dataset_AF")
    inside = _inside(max_af, min_samples)
    totals = counted.groupBy("CHROM").agg(
        F.count("*").alias("variants"), F.sum("pairs").alias("pairs"), F.sum("pairs_qc").alias("pairs_after_qc"),
        F.sum(F.when(inside, F.col("pairs_outside")).otherwise(0)).alias("pairs_after_rare"),
        F.max(F.col("n_samples") >= min_samples).alias("_inside_applied"),
    )
    types = _rows_per_class(unfiltered, frequencies, "Variant_Type", max_af, min_samples, **thresholds)
    return funnel_rows(samples, totals, types)
