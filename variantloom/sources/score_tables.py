"""Genome-wide score tables stored for lookups.

A table is cut into parts by contig and stretch and bucketed by the lookup's keys. Consecutive parts of a contig share a
folder until its files are worth opening, so their number follows the rows and not the number of parts. A lookup reads the
folders in which it has variants and joins bucket by bucket: the score side, billions of rows, is neither read whole nor
shuffled. The table describes itself (``_layout``, and ``_parts``: which folder holds a part), so any session can open it.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.session import ensure_checkpoint_dir
from variantloom.schemas import VARIANT_COLUMNS

PART_BP = 50_000_000
BUCKETS = 256
TRANSCRIPT = "_transcript"
# Rows a file should have before the next part gets a folder of its own.
FILE_ROWS = 10_000


def unversioned(df):
    """Add the transcript without its version, which score tables carry and annotators may leave out."""
    return df.withColumn(TRANSCRIPT, F.regexp_replace("Feature", r"\.\d+$", ""))


def stretch_of(part_bp):
    return F.floor(F.col("POS") / part_bp).alias("_stretch")


def part_folders(rows, part_bp, folder_rows):
    """``CHROM, _stretch, _part``: the folder of every part that has rows, named by its first part.

    A folder takes the parts whose first row is in the same ``folder_rows`` rows of the contig. Parts are bounded by the genome's length.
    """
    so_far = Window.partitionBy("CHROM").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("CHROM", stretch_of(part_bp)).agg(F.count("*").alias("_rows"))
        .withColumn("_cut", F.floor(F.coalesce(F.sum("_rows").over(so_far), F.lit(0)) / folder_rows))
        .withColumn("_first", F.min("_stretch").over(Window.partitionBy("CHROM", "_cut")))
        .select("CHROM", "_stretch", F.concat_ws("_", "CHROM", F.col("_first").cast("string")).alias("_part"))
    )


def store_scores(scores, path, by_transcript=False, buckets=BUCKETS, part_bp=PART_BP, file_rows=FILE_ROWS):
    """Write ``scores`` (variant columns, payload, and ``Feature`` if ``by_transcript``) as one file for each folder of parts and bucket.

    Rows without a full key can match nothing and are left out.
    """
    spark = scores.sparkSession
    keys = [*VARIANT_COLUMNS, TRANSCRIPT] if by_transcript else VARIANT_COLUMNS
    # a transcript is missing exactly where its name is, so counting the parts takes no version off
    full = scores.dropna(subset=[*VARIANT_COLUMNS, "Feature"] if by_transcript else keys)
    rows = unversioned(full).drop("Feature") if by_transcript else full
    ensure_checkpoint_dir(spark)
    # stored, so that the table and its list of parts agree
    folders = part_folders(rows, part_bp, buckets * file_rows).checkpoint()
    placed = rows.withColumn("_stretch", stretch_of(part_bp)).join(folders, ["CHROM", "_stretch"]).select(*rows.columns, "_part")
    name = f"scores_{uuid.uuid4().hex}"
    # dealt by the bucket's own hash, so that a task writes whole buckets
    (placed.repartition(buckets, *keys).write.format("parquet").mode("overwrite").partitionBy("_part").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # its files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    layout = spark.createDataFrame([(columns, keys, buckets, part_bp)], "columns string, keys array<string>, buckets int, part_bp long")
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/_layout")
    folders.coalesce(1).write.mode("overwrite").parquet(f"{path}/_parts")


def open_scores(spark, path):
    """``(table, keys, part_bp)`` of a stored score table, buckets and parts known to the session."""
    layout = spark.read.parquet(f"{path}/_layout").first()
    name = f"scores_{hashlib.sha256(path.encode()).hexdigest()[:32]}"
    keys = ", ".join(f"`{k}`" for k in layout["keys"])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({layout['columns']}) USING parquet PARTITIONED BY (_part) "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout['buckets']} BUCKETS LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name), list(layout["keys"]), layout["part_bp"]


def stored_score_lookup(variants, path):
    """``variants`` left-joined with a stored score table; only the folders of the parts in which they lie are read.

    A table stored by transcript matches the variants' ``Feature`` without its version. As in
    :func:`~variantloom.operators.annotations.score_lookup`, several scores of one key give several rows.
    """
    spark = variants.sparkSession
    table, keys, part_bp = open_scores(spark, path)
    # at most the genome's length over ``part_bp`` names, whatever the number of variants
    asked_parts = variants.select("CHROM", stretch_of(part_bp)).distinct()
    folders = spark.read.parquet(f"{path}/_parts").join(asked_parts, ["CHROM", "_stretch"]).select("_part").distinct()
    scores = table.filter(F.col("_part").isin([row["_part"] for row in folders.collect()])).drop("_part")
    asked = unversioned(variants) if TRANSCRIPT in keys else variants
    return asked.join(scores, keys, "left").drop(TRANSCRIPT)
