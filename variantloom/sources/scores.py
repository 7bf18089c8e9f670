"""Genome-wide score files in their published text layouts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantloom.functions.text import item
from variantloom.schemas import SPLICEAI_PARTS, VARIANT_COLUMNS

# File order of the published AlphaMissense table.
ALPHAMISSENSE_FILE = ["CHROM", "POS", "REF", "ALT", "genome", "uniprot_id", "transcript_id", "protein_variant",
                      "am_pathogenicity", "am_class"]


def read_alphamissense_scores(spark, *paths):
    types = {"POS": T.IntegerType(), "am_pathogenicity": T.DoubleType()}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in ALPHAMISSENSE_FILE])
    return (
        spark.read.schema(schema).option("sep", "\t").option("comment", "#").csv(list(paths))
        .select(*VARIANT_COLUMNS, F.col("transcript_id").alias("Feature"), "am_class", "am_pathogenicity")
    )


def read_spliceai_scores(spark, *paths):
    """SNV and indel score VCFs: ``SpliceAI=ALT|SYMBOL|DS...|DP...`` in INFO, one or more genes per line."""
    fields = F.split("value", "\t")
    entries = F.split(F.regexp_extract(F.get(fields, F.lit(7)), r"SpliceAI=([^;]*)", 1), ",")
    return (
        spark.read.text(list(paths)).filter(~F.col("value").startswith("#"))
        .select(F.get(fields, F.lit(0)).alias("CHROM"), F.get(fields, F.lit(1)).try_cast("int").alias("POS"), F.get(fields, F.lit(3)).alias("REF"),
                F.explode(entries).alias("entry"))
        .select("CHROM", "POS", "REF", item("entry", r"\|", 0).alias("ALT"),
                *[item("entry", r"\|", i + 1).alias(name) for i, name in enumerate(SPLICEAI_PARTS)])
    )
