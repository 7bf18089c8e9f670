"""Per-sample call files, the calls table, and the unfiltered table."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.text import decoded_path
from variantloom.schemas import CALL_TSV, CALLS, COHORT_TSV, CURATED, UNFILTERED

CALL_FILES = "*.{tsv,csv}.gz"  # our own sink names its parts .csv.gz
SAMPLE_FROM_FOLDER = r"/SampleID=([^/]+)/[^/]*$"


def sample_from_path(path):
    """Sample name of a call file: its stem, or its ``SampleID=`` folder when written by our own sink."""
    folder = F.regexp_extract(path, SAMPLE_FROM_FOLDER, 1)
    # a partition folder is escaped once by the writer and once more in the file URI
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[ct]sv\.gz$", "")
    name = F.when(folder != "", decoded_path(decoded_path(folder))).otherwise(decoded_path(stem))
    return F.when(name != "", name).otherwise(F.raise_error(F.concat(F.lit("no sample name in "), path)))


def read_call_tsvs(spark, path):
    """All call TSVs below ``path`` in one scan; small files share tasks, so there is no per-file job.

    ``-`` is null. Values that do not parse become null. ``SampleID`` comes from the file path. A file whose
    header names other columns, or the same in another order, fails instead of being read by position.
    """
    return (
        spark.read.schema(CALL_TSV)
        .option("sep", "\t").option("header", True).option("nullValue", "-").option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", CALL_FILES)
        .csv(path)
        .withColumn("SampleID", sample_from_path(F.col("_metadata.file_path")))
    )


def read_cohort_tsvs(spark, path):
    """Call TSVs of many samples a file, with ``SampleID`` as their first column (see ``write_cohort_tsvs``)."""
    return (
        spark.read.schema(COHORT_TSV)
        .option("sep", "\t").option("header", True).option("nullValue", "-").option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", CALL_FILES)
        .csv(path)
        .select(*CALL_TSV.names, "SampleID")
    )


def read_calls(spark, *paths):
    """Calls tables (one or more batch folders) as one DataFrame."""
    return spark.read.schema(CALLS).parquet(*paths)


def read_unfiltered(spark, path):
    return spark.read.schema(UNFILTERED).parquet(path)


def read_curated(spark, path):
    return spark.read.schema(CURATED).parquet(path)
