"""Variant-by-sample matrix exports: one row per variant with an array of entries."""

from __future__ import annotations

from variantloom.schemas import ENTRIES


def row_by_row(spark):
    """Have the session read nested Parquet columns a row at a time.

    A matrix row holds an entry for every sample. The columnar reader takes 4,096 rows at once whatever their size:
    with 400,000 samples that is 1.6 billion entries in a task. One row has a few tens of MB.
    """
    spark.conf.set("spark.sql.parquet.enableNestedColumnVectorizedReader", "false")


def read_entries(spark, path):
    """Entries of a matrix; call :func:`row_by_row` first where rows are wide."""
    return spark.read.schema(ENTRIES).parquet(path)
