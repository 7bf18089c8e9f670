"""Explicit schemas and fixed column lists. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names, contigs and constants of the public file formats -------------

CANONICAL_CONTIGS = [
    "chr1", "chr2", "chr3", "chr4", "chr5", "chr6", "chr7", "chr8", "chr9", "chr10", "chr11", "chr12",
    "chr13", "chr14", "chr15", "chr16", "chr17", "chr18", "chr19", "chr20", "chr21", "chr22", "chrX", "chrY",
]

UNCALLED_GENOTYPES = ["0/0", "0|0", "./.", ".|."]

GNOMAD_AF_COLUMNS = [
    "gnomADe_AF", "gnomADe_AFR_AF", "gnomADe_AMR_AF", "gnomADe_ASJ_AF", "gnomADe_EAS_AF", "gnomADe_FIN_AF",
    "gnomADe_MID_AF", "gnomADe_NFE_AF", "gnomADe_REMAINING_AF", "gnomADe_SAS_AF",
    "gnomADg_AF", "gnomADg_AFR_AF", "gnomADg_AMI_AF", "gnomADg_AMR_AF", "gnomADg_ASJ_AF", "gnomADg_EAS_AF",
    "gnomADg_FIN_AF", "gnomADg_MID_AF", "gnomADg_NFE_AF", "gnomADg_REMAINING_AF", "gnomADg_SAS_AF",
]

SPLICEAI_PARTS = ["SYMBOL", "DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL"]
SPLICEAI_DELTAS = ["DS_AG", "DS_AL", "DS_DG", "DS_DL"]
LOFTEE_COLUMNS = ["LoF", "LoF_filter", "LoF_flags", "LoF_info"]
ALPHAMISSENSE_COLUMNS = ["am_class", "am_pathogenicity"]

ANNOTATION_KEYS = ["Uploaded_variation", "Location", "Allele", "Gene", "Feature"]

CALL_COLUMNS = ["SampleID", "CHROM", "POS", "REF", "ALT", "GT", "DP", "GQ", "REF_AD", "ALT_AD", "ID"]
CALL_TSV_COLUMNS = ["CHROM", "POS", "REF", "ALT", "GT", "DP", "AD", "GQ"]
VARIANT_COLUMNS = ["CHROM", "POS", "REF", "ALT"]

VARIANT_TYPES = ["Synonymous", "Stop_Gained", "Frameshift", "Splice_variants", "Missense", "Other"]

CURATED_COLUMNS = [
    "SampleID", "CHROM", "POS", "REF", "ALT", "GT", "DP", "GQ", "REF_AD", "ALT_AD", "AC_ratio", "Gene",
    "Feature", "CANONICAL", "MANE", "dataset_AF", "gnomAD_max_AF", "MAX_AF", "MAX_AF_POPS", "Variant_Type",
    "am_pathogenicity", "Max_DS_SpliceAI",
]

VCF_HEADER = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"

# --- end of fixed values ---------------------------------------------------------------------

PLUGINS = ["spliceai", "alphamissense", "loftee"]

_INTEGERS = ["POS", "DP", "GQ", "REF_AD", "ALT_AD"]
_DOUBLES = ["MAX_AF", "gnomAD_max_AF", "am_pathogenicity", "AC_ratio", "dataset_AF", "Max_DS_SpliceAI"]
_NUMERIC = {**{c: T.IntegerType() for c in _INTEGERS}, **{c: T.DoubleType() for c in _DOUBLES}}


def _struct(names):
    return T.StructType([T.StructField(n, _NUMERIC.get(n, T.StringType())) for n in names])


MANIFEST = T.StructType([T.StructField("sampleID", T.StringType()), T.StructField("Path", T.StringType())])

CALL_TSV = _struct(CALL_TSV_COLUMNS)
COHORT_TSV = _struct(["SampleID", *CALL_TSV_COLUMNS])

CALLS = _struct(CALL_COLUMNS)

ANNOTATION_PAYLOAD = {
    "default": ["Consequence", "CANONICAL", "MANE", "MAX_AF", "MAX_AF_POPS"] + GNOMAD_AF_COLUMNS,
    "loftee": LOFTEE_COLUMNS,
    "alphamissense": ALPHAMISSENSE_COLUMNS,
    "spliceai": ["SpliceAI_pred"],
}


def annotation_schema(columns):
    """Schema of an annotator table with ``columns`` in file order.

    Population frequencies stay text here; ``reshape_annotation`` converts them with ``try_cast``.
    """
    return _struct(columns)


def annotation_columns(plugin):
    return ANNOTATION_KEYS + ANNOTATION_PAYLOAD[plugin]


TABLE_PAYLOAD = {
    "default": ["Consequence", "CANONICAL", "MANE", "MAX_AF", "MAX_AF_POPS", "gnomAD_max_AF"],
    "loftee": LOFTEE_COLUMNS,
    "alphamissense": ALPHAMISSENSE_COLUMNS,
    "spliceai": SPLICEAI_PARTS,
}


def annotation_table_schema(plugin):
    """Schema of a converted annotation table; with it, a table without any row still reads."""
    return _struct(["ID", "Location", "Allele", "Gene", "Feature", *TABLE_PAYLOAD[plugin], "ID_variant_gene", "Chr"])


UNFILTERED = _struct(["ID", *[c for c in CALL_COLUMNS if c != "ID"], "Gene", "Feature",
                      *[c for p in ["default", *PLUGINS] for c in TABLE_PAYLOAD[p]]])

CURATED = _struct(CURATED_COLUMNS)

ENTRIES = T.StructType([
    T.StructField("locus", T.StructType([T.StructField("contig", T.StringType()),
                                         T.StructField("position", T.IntegerType())])),
    T.StructField("alleles", T.ArrayType(T.StringType())),
    T.StructField("entries", T.ArrayType(T.StructType([
        T.StructField("s", T.StringType()),
        T.StructField("GT", T.StructType([T.StructField("alleles", T.ArrayType(T.IntegerType())),
                                          T.StructField("phased", T.BooleanType())])),
        T.StructField("AD", T.ArrayType(T.IntegerType())),
        T.StructField("GQ", T.IntegerType()),
    ]))),
])
