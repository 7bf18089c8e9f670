"""Cohort frequencies that grow by batches: who carries a variant, as sets of sample numbers that are merged.

Samples are numbered once. A batch's rows become, for each variant and bucket of 32,768 numbers, the set of its carriers: the
numbers themselves where they are few, a bitmap of fixed size where they are many. Sets of several batches are
united, so a sample that is in two batches counts once, and a new batch needs the stored sets only, not the
cohort's calls. Samples per chromosome, the denominator, are sets of the same kind.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.operators.curate import on_contigs, qc_filter, with_counts
from variantloom.operators.joins import splittable_join
from variantloom.operators.manifest import number_rows
from variantloom.schemas import VARIANT_COLUMNS

# A bitmap takes 4,096 bytes; fewer numbers than this are stored as they are.
FEW = 512
SETS = ["bucket", "few", "bits"]


def number_samples(samples, known=None):
    """``SampleID, number`` of the samples that ``known`` does not have: consecutive numbers after its last one, from 1.

    Store the result: it is the samples' numbering from then on.
    """
    new = samples.select("SampleID").filter("SampleID IS NOT NULL").distinct()
    last = 0
    if known is not None:
        last = known.agg(F.max("number")).first()[0] or 0
        new = new.join(known, "SampleID", "left_anti")
    ordered = new.orderBy("SampleID").withColumn("line", F.monotonically_increasing_id())
    return number_rows(ordered).select("SampleID", (F.col("rn") + last).cast("long").alias("number"))


def member_sets(rows, numbers, keys):
    """Sets of the samples of ``rows`` by ``keys``: ``bucket`` and either ``few`` or ``bits``. Rows without a sample are in none.

    A group is all of one bucket's numbers at most, whatever the number of rows. Every sample of ``rows`` has a number.
    """
    numbered = splittable_join(rows.select(*keys, "SampleID").filter("SampleID IS NOT NULL"), numbers, ["SampleID"], "left")
    number = F.coalesce("number", F.raise_error(F.concat(F.lit("no number for sample "), "SampleID")).cast("long"))
    members = numbered.select(*keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).cast("int").alias("at"))
    return as_sets(members, keys)


def as_sets(members, keys):
    """Rows ``keys, bucket, at`` as sets; only buckets with many members become bitmaps."""
    sets = members.groupBy(*keys, "bucket").agg(F.collect_set("at").alias("few"))
    many = sets.filter(F.size("few") >= FEW).select(*keys, "bucket", F.explode("few").alias("at"))
    bits = many.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    return sets.filter(F.size("few") < FEW).unionByName(bits, allowMissingColumns=True).select(*keys, *SETS)


def union_sets(sets, keys):
    """Sets of several batches, united: one set for each key and bucket."""
    few = sets.filter("few IS NOT NULL").select(*keys, "bucket", F.explode("few").alias("at"))
    many = sets.filter("bits IS NOT NULL").select(*keys, "bucket", "bits")
    dense, on = many.select(*keys, "bucket").distinct(), [*keys, "bucket"]
    added = few.join(dense, on, "left_semi").groupBy(*on).agg(F.bitmap_construct_agg("at").alias("bits"))
    bits = many.unionByName(added).groupBy(*on).agg(F.bitmap_or_agg("bits").alias("bits"))
    return as_sets(few.join(dense, on, "left_anti"), keys).unionByName(bits, allowMissingColumns=True).select(*keys, *SETS)


def member_counts(sets, keys, name):
    """``keys`` and how many samples are in the united sets."""
    sized = union_sets(sets, keys).withColumn("_size", F.when(F.col("bits").isNull(), F.size("few").cast("long")).otherwise(F.bitmap_count("bits")))
    return sized.groupBy(*keys).agg(F.sum("_size").alias(name))


def carrier_sets(unfiltered, numbers, **thresholds):
    """Of one batch of annotated calls: carriers by variant after quality control. A variant has all its coordinates."""
    return member_sets(qc_filter(unfiltered, **thresholds).dropna(subset=VARIANT_COLUMNS), numbers, VARIANT_COLUMNS)


def sample_sets(unfiltered, numbers):
    """Of one batch of annotated calls: samples by chromosome, before quality control."""
    return member_sets(unfiltered.dropna(subset=["CHROM"]), numbers, ["CHROM"])


def stored_frequencies(carriers, samples, contigs=None):
    """As :func:`~variantloom.operators.curate.variant_frequencies`, from the sets of all batches."""
    carriers = member_counts(on_contigs(carriers, contigs), VARIANT_COLUMNS, "_carriers")
    counted = with_counts(carriers, member_counts(on_contigs(samples, contigs), ["CHROM"], "n_samples"), contigs)
    return counted.select(*VARIANT_COLUMNS, "n_samples", F.try_divide(F.col("_carriers"), F.lit(2) * F.col("n_samples")).alias("dataset_AF"))
