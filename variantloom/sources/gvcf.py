"""gVCF text as rows, one task per compressed file and nothing buffered."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.text import decoded_path, format_field


def read_gvcf_lines(spark, *paths):
    """Raw lines with the path they came from. gzip and block-gzip files both read as gzip."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").text(list(paths))
        .select("value", F.col("_metadata.file_path").alias("path"))
    )


def read_gathered_gvcfs(spark, *paths):
    """As :func:`read_gvcf_lines`, from files that gather the lines of many gVCFs, each after its own path and a tab.

    Opening a file costs far more than reading a sample's lines, so a cohort of very many samples is gathered once.
    """
    lines = read_gvcf_lines(spark, *paths).select("value")
    tab = F.expr("locate('\t', value)")
    return lines.select(F.expr("substr(value, locate('\t', value) + 1)").alias("value"), F.col("value").substr(F.lit(1), tab - 1).alias("path"))


def is_short():
    """A line that is no header and has fewer than its ten columns."""
    return ~F.col("value").startswith("#") & F.get(F.split("value", "\t"), F.lit(9)).isNull()


def short_lines(lines):
    """``path, short_lines`` of the files that have any."""
    return lines.filter(is_short()).groupBy("path").agg(F.count(F.lit(1)).alias("short_lines"))


def parse_gvcf(lines, observation=None):
    """Typed records of single-sample gVCF lines.

    Header lines and pure reference blocks go first, before any field is taken apart. Metrics stay
    text so that ``.`` can be told from a number; columns other than ``value`` are carried along. A line
    without its ten columns is no record and is left out; ``observation`` counts those as ``short_lines`` while the lines are read.
    """
    if observation is not None:
        lines = lines.observe(observation, F.count_if(is_short()).alias("short_lines"))
    fields = F.split("value", "\t")
    part = lambda i: F.get(fields, F.lit(i))
    alt, fmt, sample = part(4), part(8), part(9)
    carried = [c for c in lines.columns if c != "value"]
    return (
        lines.filter(~F.col("value").startswith("#"))
        .filter(~F.coalesce(F.get(fields, F.lit(4)), F.lit(".")).isin(".", "<NON_REF>", "<*>"))
        .filter(sample.isNotNull())
        .select(
            *carried,
            part(0).alias("CHROM"), part(1).try_cast("int").alias("POS"),
            part(3).alias("REF"), alt.alias("ALT"),
            *[format_field(fmt, sample, key).alias(key) for key in ("GT", "DP", "AD", "GQ")],
        )
    )


def base_name(path):
    return F.element_at(F.split(path, "/"), -1)


def plain_path(path):
    """A path without its scheme and escapes, as a manifest lists it."""
    return F.regexp_replace(decoded_path(path), r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")


def attach_samples(records, manifest):
    """Add ``SampleID`` by the path of the file, keeping only files the manifest lists.

    A file at another path than listed is found by its base name. If the manifest lists that name more than once,
    its sample is not known and this fails. Files of which neither path nor name is listed are left out; see
    :func:`unlisted_files`. Call it after the site filter: records of reference blocks never reach the joins.
    """
    sample = F.coalesce("by_path", F.when(F.col("paths") > 1, F.raise_error(F.concat(
        F.lit("file is not listed, and its base name is listed more than once: "), "path")).cast("string")).otherwise(F.col("by_name")))
    found = listed_samples(records, manifest).withColumn("SampleID", sample).filter("SampleID IS NOT NULL")
    return found.drop("file", "full", "path", "by_path", "by_name", "paths")


def listed_samples(rows, manifest):
    """Add ``by_path``, and ``by_name`` and ``paths`` of the base name: how many listed files have it."""
    listed = manifest.select(F.col("sampleID").alias("SampleID"), F.col("Path")).distinct()
    by_path = listed.select(plain_path(F.col("Path")).alias("full"), F.col("SampleID").alias("by_path")).distinct()
    by_name = listed.groupBy(base_name(F.col("Path")).alias("file")).agg(
        F.max("SampleID").alias("by_name"), F.countDistinct("Path").alias("paths"))
    return (rows.withColumn("full", plain_path(F.col("path"))).withColumn("file", base_name(F.col("full")))
            .join(by_path, "full", "left").join(by_name, "file", "left"))


def unlisted_files(files, manifest):
    """``path`` of the files that no manifest row lists by path or base name. ``files``: rows with ``path``."""
    found = listed_samples(files.select("path").distinct(), manifest)
    return found.filter("by_path IS NULL AND paths IS NULL").select("path")


def listed_files(files, rows, manifest):
    """``path`` of the files that ``rows`` of ``manifest`` list: by path, or a moved one by its base name.

    A file whose path the manifest lists belongs to that row alone, whatever it is called.
    """
    there = files.select("path", plain_path(F.col("path")).alias("full")).distinct()
    paths = lambda df: df.select(plain_path(F.col("Path")).alias("full")).distinct()
    moved = missing_by_path(there, rows).select(base_name(F.col("Path")).alias("file")).distinct()
    by_name = there.join(paths(manifest), "full", "left_anti").withColumn("file", base_name(F.col("full"))).join(moved, "file", "left_semi")
    return there.join(paths(rows), "full", "left_semi").select("path").union(by_name.select("path"))


def missing_by_path(there, rows):
    return rows.withColumn("full", plain_path(F.col("Path"))).join(there.select("full"), "full", "left_anti").drop("full")


def missing_files(files, manifest):
    """Manifest rows with neither their path nor their base name among ``files``."""
    there = files.select(plain_path(F.col("path")).alias("full")).distinct()
    names = there.select(base_name(F.col("full")).alias("file")).distinct()
    rows = missing_by_path(there, manifest).withColumn("file", base_name(F.col("Path")))
    return rows.join(names, "file", "left_anti").drop("file")


def gvcf_files(spark, *paths):
    """``path`` of the files that :func:`read_gvcf_lines` reads, without reading their contents."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(list(paths))
        .select("path")
    )
