"""Annotator output to annotation tables, and score lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.text import item
from variantloom.functions.variant import annotation_key, any_present
from variantloom.schemas import (ALPHAMISSENSE_COLUMNS, GNOMAD_AF_COLUMNS, LOFTEE_COLUMNS, SPLICEAI_PARTS, TABLE_PAYLOAD,
                                 VARIANT_COLUMNS, annotation_table_schema)
from variantloom.sources.score_tables import TRANSCRIPT, stored_score_lookup, unversioned


def _default(raw):
    highest = F.greatest(*[F.col(c).try_cast("double") for c in GNOMAD_AF_COLUMNS])
    return (
        raw.withColumns({
            "MAX_AF": F.coalesce(F.col("MAX_AF"), F.lit(0.0)),
            "gnomAD_max_AF": F.coalesce(highest, F.lit(0.0)),
        }).drop(*GNOMAD_AF_COLUMNS)
    )


def _spliceai(raw):
    parts = {name: item("SpliceAI_pred", r"\|", i) for i, name in enumerate(SPLICEAI_PARTS)}
    return raw.filter(F.col("SpliceAI_pred").isNotNull()).withColumns(parts).drop("SpliceAI_pred")


def _alphamissense(raw):
    return raw.filter(any_present(ALPHAMISSENSE_COLUMNS))


def _loftee(raw):
    return raw.filter(any_present(LOFTEE_COLUMNS))


_RESHAPE = {"default": _default, "spliceai": _spliceai, "alphamissense": _alphamissense, "loftee": _loftee}


def reshape_annotation(raw, plugin):
    """Raw annotator rows of one plugin to its table.

    Default: highest population frequency, unknown frequencies become 0.0 (rare). Plugins: rows
    without a payload are dropped, which a left join cannot tell.
    """
    return (
        _RESHAPE[plugin](raw)
        .withColumn("ID_variant_gene", annotation_key())
        .withColumnRenamed("Uploaded_variation", "ID")
    )


def primary_transcripts(default):
    return default.filter(F.col("MANE").isNotNull() | F.col("CANONICAL").isNotNull())


def score_lookup(variants, scores, match_feature=False):
    """Left-join genome-wide scores on the exact alleles (and on the transcript when asked).

    The score side is the big one and holds few rows per variant, so this is a plain equi-join. Transcripts match
    without their versions, which score tables carry and annotators may leave out.
    """
    if not match_feature:
        return variants.join(scores, VARIANT_COLUMNS, "left")
    joined = unversioned(variants).join(unversioned(scores).drop("Feature"), [*VARIANT_COLUMNS, TRANSCRIPT], "left")
    return joined.drop(TRANSCRIPT)


def plugin_table(default, variants, scores_path, plugin):
    """A plugin's annotation table looked up in a stored score table instead of run by the annotator.

    ``default`` has the transcripts of each variant, ``variants`` the coordinates behind each ID. A transcript without
    a score has no row, as in a reshaped plugin table.
    """
    asked = default.select("ID", "Location", "Allele", "Gene", "Feature", "ID_variant_gene", "Chr").join(
        variants.select("ID", *VARIANT_COLUMNS), "ID")
    found = stored_score_lookup(asked, scores_path).filter(any_present(TABLE_PAYLOAD[plugin]))
    return found.select(*annotation_table_schema(plugin).names)
