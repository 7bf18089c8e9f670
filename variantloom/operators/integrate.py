"""Annotations joined together, then to the calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from variantloom.functions.variant import variant_id
from variantloom.operators.annotations import primary_transcripts
from variantloom.operators.joins import splittable_join

_SHARED = ["ID", "Chr", "Location", "Allele", "Gene", "Feature"]


def integrate(default, plugins, strict_key=False):
    """Primary-transcript annotations left-joined with each plugin on ``ID_variant_gene``.

    All joins use one key, so the default side is shuffled once. Repeated keys multiply rows, as
    the text key allows; ``strict_key`` adds the variant ID to the key.
    """
    keys = ["ID_variant_gene"] + (["ID"] if strict_key else [])
    scaffold = [c for c in _SHARED if c not in keys]
    return reduce(lambda left, plugin: left.join(plugin.drop(*scaffold), keys, "left"),
                  plugins, primary_transcripts(default))


def _join_calls(calls, known, how="inner"):
    """Calls joined by ``CHROM, ID`` without the IDs in the shuffle: an ID that its coordinates do not spell stays beside the call."""
    odd = F.when(~F.col("ID").eqNullSafe(variant_id()), F.struct("ID"))
    spelled = F.when(F.col("_odd").isNull(), variant_id()).otherwise(F.col("_odd.ID"))
    return splittable_join(calls.withColumn("_odd", odd).drop("ID"), known, ["CHROM", "ID"], how, {"ID": spelled}).drop("_odd")


def annotate_calls(calls, annotations):
    """Calls inner-joined with their annotations: one row per call and primary transcript.

    CHROM is part of the key, so both sides prune and a partitioned read stays partitioned. A variant
    carried by most samples is a hot key on the call side only; adaptive execution splits it and
    repeats the few annotation rows.
    """
    payload = [c for c in annotations.columns if c not in ("ID", "ID_variant_gene", "Chr", "Location", "Allele")]
    known = annotations.select(F.col("Chr").alias("CHROM"), "ID", *payload)
    rest = [c for c in calls.columns if c != "ID"]
    return _join_calls(calls, known).select("ID", *rest, *payload)


def annotated_ids(annotations):
    """Distinct ``CHROM, ID`` of the annotations.

    Under a distinct that reads none of their columns the plugins' left joins change nothing, and the
    optimizer leaves them out.
    """
    return annotations.select(F.col("Chr").alias("CHROM"), "ID").distinct()


def annotated_calls(calls, annotations):
    """Calls whose variant has at least one annotation, without the annotation columns."""
    return _join_calls(calls, annotated_ids(annotations), "left_semi").select(*calls.columns)


def id_coverage(calls, annotations):
    """Distinct IDs per chromosome found in both tables, only in the calls, only in the annotations.

    One tagged union and two aggregations replace the intersect and the two subtracts. Chromosomes
    without any call are left out.
    """
    tagged = calls.select("CHROM", "ID", F.lit(1).alias("called"), F.lit(0).alias("annotated")).unionByName(
        annotated_ids(annotations).withColumns({"called": F.lit(0), "annotated": F.lit(1)}))
    per_id = tagged.groupBy("CHROM", "ID").agg(F.max("called").alias("c"), F.max("annotated").alias("a"))
    return (
        per_id.groupBy("CHROM").agg(
            F.count_if((F.col("c") == 1) & (F.col("a") == 1)).alias("shared"),
            F.count_if((F.col("c") == 1) & (F.col("a") == 0)).alias("calls_only"),
            F.count_if((F.col("c") == 0) & (F.col("a") == 1)).alias("annotation_only"),
        )
        .filter(F.col("shared") + F.col("calls_only") > 0)
    )
