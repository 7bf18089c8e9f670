from pyspark.sql import functions as F

from variantloom.schemas import ANNOTATION_PAYLOAD, CALLS, GNOMAD_AF_COLUMNS, annotation_columns, annotation_schema
from pyspark.sql import types as T


def records(df, *columns):
    """Rows as sorted tuples; nulls first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


def call(sample="S1", chrom="chr1", pos=100, ref="A", alt="G", gt="0/1", dp=40, gq=50, ref_ad=20, alt_ad=20):
    return (sample, chrom, pos, ref, alt, gt, dp, gq, ref_ad, alt_ad, f"{chrom}_{pos}_{ref}_{alt}")


def calls(spark, *rows):
    return spark.createDataFrame(list(rows), CALLS)


UNFILTERED_EXTRA = {
    "Gene": "G1", "Feature": "T1", "Consequence": "synonymous_variant", "CANONICAL": "YES", "MANE": None,
    "MAX_AF": 0.0, "MAX_AF_POPS": None, "gnomAD_max_AF": 0.0, "SYMBOL": None, "DS_AG": None, "DS_AL": None,
    "DS_DG": None, "DS_DL": None, "DP_AG": None, "DP_AL": None, "DP_DG": None, "DP_DL": None, "am_class": None,
    "am_pathogenicity": None, "LoF": None, "LoF_filter": None, "LoF_flags": None, "LoF_info": None,
}


def unfiltered(spark, *rows):
    """Rows are ``(call, overrides)``."""
    doubles = {"MAX_AF", "gnomAD_max_AF", "am_pathogenicity"}
    schema = T.StructType(CALLS.fields + [
        T.StructField(n, T.DoubleType() if n in doubles else T.StringType()) for n in UNFILTERED_EXTRA])
    return spark.createDataFrame([c + tuple({**UNFILTERED_EXTRA, **o}.values()) for c, o in rows], schema)


def raw_annotation(spark, plugin, *rows):
    """Rows are dicts of column values; ``Chr`` defaults to chr1."""
    columns = annotation_columns(plugin)
    schema = T.StructType(annotation_schema(columns).fields + [T.StructField("Chr", T.StringType())])
    return spark.createDataFrame([tuple(r.get(c) for c in columns) + (r.get("Chr", "chr1"),) for r in rows], schema)
