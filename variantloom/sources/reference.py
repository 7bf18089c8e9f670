"""Reference sequence as overlapping blocks, from FASTA text and its index."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.operators.manifest import number_rows

_CHUNK = 65_536


def read_index(spark, path):
    """FASTA index rows with ``header``, the 1-based line number of the contig's ``>`` line.

    The index has one row per contig, so one ordered window over it is small.
    """
    index = (
        spark.read.schema("CHROM string, length bigint, offset bigint, line_bases int, line_width int")
        .option("sep", "\t").csv(path)
        .withColumn("lines", F.ceil(F.col("length") / F.col("line_bases")))
    )
    before = F.sum(F.col("lines") + 1).over(Window.orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    return index.withColumn("header", F.coalesce(before, F.lit(0)) + 1)


def read_reference_blocks(spark, fasta, index, block_bp=960, line_bases=None):
    """``CHROM, block, start, seq``: blocks of ``block_bp`` bases, each with the block before in front.

    Lines are numbered without bringing the file into one task, placed on their contig through the
    index, and put together per block; a block holds ``2 * block_bp / line_bases`` lines at most.
    The width of a contig's lines is that of its index row, unless ``line_bases`` gives one for all. A width that does not divide ``block_bp`` fails, unless the contig
    is one line that fits a block.
    """
    lines = number_rows(spark.read.text(fasta).withColumn("line", F.monotonically_increasing_id()))
    fits = (F.lit(block_bp) % F.col("line_bases") == 0) | ((F.col("lines") <= 1) & (F.col("length") <= block_bp))
    width = F.when(fits, F.col("line_bases")).otherwise(F.raise_error(F.concat(
        F.lit(f"{block_bp} bases a block are no multiple of the lines of "), "CHROM")).cast("int"))
    contigs = read_index(spark, index)
    contigs = (contigs if line_bases is None else contigs.withColumn("line_bases", F.lit(line_bases))).select(
        "CHROM", "header", "lines", width.alias("line_bases"),
        F.explode(F.sequence(F.floor(F.col("header") / _CHUNK), F.floor((F.col("header") + F.col("lines")) / _CHUNK)))
        .alias("chunk"))
    placed = (
        lines.withColumn("chunk", F.floor(F.col("rn") / _CHUNK)).join(contigs, "chunk")
        .filter((F.col("rn") > F.col("header")) & (F.col("rn") <= F.col("header") + F.col("lines")))
        .withColumn("first", (F.col("rn") - F.col("header") - 1) * F.col("line_bases") + 1)
    )
    own = F.floor((F.col("first") - 1) / block_bp)
    # a line belongs to its block and is the run-up of the next one
    copies = placed.select("CHROM", "first", "value", F.explode(F.array(own, own + 1)).alias("block"))
    grouped = copies.groupBy("CHROM", "block").agg(F.sort_array(F.collect_list(F.struct("first", "value"))).alias("parts"))
    return grouped.select(
        "CHROM", "block", F.col("parts")[0]["first"].cast("int").alias("start"),
        F.array_join(F.transform("parts", lambda p: p["value"]), "").alias("seq"))
