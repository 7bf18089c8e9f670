"""Annotator tab files and the annotation tables made from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from variantloom.functions.text import decoded_path, literal_path
from variantloom.schemas import ANNOTATION_KEYS, annotation_columns, annotation_schema, annotation_table_schema

# The contig of a row is what stands before the last colon of its location.
CONTIG_OF_LOCATION = r"^(.*):[^:]*$"
FILES = {"recursiveFileLookup": True, "pathGlobFilter": "*.tsv.gz"}
# The header: a comment line, not one of two marks, in which the variant's column is named.
HEADER = rf"^#([^\t]*\t)*{ANNOTATION_KEYS[0]}(\t|$)"
# Column orders that one folder may mix; each is one scan of its files.
MOST_LAYOUTS = 100


def header_columns(spark, path):
    """Column names from the one ``#`` line of an annotator file that is not a ``##`` line."""
    line = spark.read.text(path).filter(F.col("value").rlike("^#[^#]")).head()
    if line is None:
        raise ValueError(f"no header line in {path}")
    return line["value"].lstrip("#").split("\t")


def file_layouts(spark, path):
    """``path, header`` of every annotator file below ``path``; null for a file that has no header line.

    A pass over the files' text; what is kept of it is one line for each file.
    """
    files = (spark.read.format("binaryFile").options(**FILES).load(path).select("path"))  # names alone, no contents
    lines = spark.read.options(**FILES).text(path).filter(F.col("value").rlike(HEADER) & ~F.startswith("value", F.lit("##")))
    headers = lines.groupBy(decoded_path(F.col("_metadata.file_path")).alias("full")).agg(F.min("value").alias("header"))
    plain = F.regexp_replace(F.col("path"), "^file:/+", "/")
    return (files.withColumn("full", plain)
            .join(headers.withColumn("full", F.regexp_replace("full", "^file:/+", "/")), "full", "left").select("path", "header"))


def layout_columns(header, plugin, path):
    """Column names of a header line; raises unless it has each of the plugin's columns once."""
    columns = header.lstrip("#").split("\t")
    missing = [c for c in annotation_columns(plugin) if columns.count(c) != 1]
    if missing:
        raise ValueError(f"{path}: columns missing or named twice: {', '.join(missing)}")
    return columns


def _scan(spark, paths, columns):
    return (spark.read.schema(annotation_schema(columns)).option("sep", "\t").option("comment", "#").option("nullValue", "-")
            .options(**FILES).csv(paths))


def read_annotation_tsvs(spark, path, plugin, columns=None):
    """Every ``*.tsv.gz`` below ``path``, whatever part of a contig a file holds, with the plugin's columns.

    Each file's own header says where its columns are. Files of one layout are one scan, read by these names, and the scans are
    united by name; further columns are left out. A file without a header line, or without one of the plugin's columns,
    fails. ``columns`` gives the order of all files instead (see :func:`header_columns`) and asks for no header.
    An empty folder gives an empty DataFrame with the full schema. A location without a contig fails.
    """
    wanted = columns or annotation_columns(plugin)
    if columns:
        scans = [_scan(spark, path, columns)]
    else:
        # as many rows as there are column orders; the paths are those the driver lists for the scans
        layouts = file_layouts(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).limit(MOST_LAYOUTS + 1).collect()
        if len(layouts) > MOST_LAYOUTS:
            raise ValueError(f"more than {MOST_LAYOUTS} different headers below {path}")
        for layout in layouts:
            if layout["header"] is None:
                raise ValueError(f"no header line in {layout['paths'][0]}")
        named = [(layout["paths"], layout_columns(layout["header"], plugin, layout["paths"][0])) for layout in layouts]
        if len(named) == 1:
            scans = [_scan(spark, path, named[0][1])]
        else:
            scans = [_scan(spark, [literal_path(p) for p in paths], names) for paths, names in named] or [_scan(spark, path, wanted)]
    located = F.when(F.col("Location").contains(":"), F.regexp_extract("Location", CONTIG_OF_LOCATION, 1)).when(
        F.col("Location").isNotNull(), F.raise_error(F.concat(F.lit("no contig in location "), "Location")).cast("string"))
    return reduce(lambda a, b: a.unionByName(b), [s.select(*wanted) for s in scans]).withColumn("Chr", located)


def read_annotation_table(spark, path, plugin):
    """A converted annotation table, partitioned by ``Chr``; it may be empty."""
    return spark.read.schema(annotation_table_schema(plugin)).parquet(path)
