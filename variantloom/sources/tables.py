"""Any stored table, for the column profile."""

from __future__ import annotations

from pyspark.sql import functions as F


def read_stored_table(spark, path):
    """A Parquet file, a folder of files, or folders in folders, partitioned (``column=value``) or not.

    Spark's reader passes over files in nested folders whose names are no partitions unless it is told to look for
    them, and then it no longer makes columns of those that are. So the names of the files decide, contents unread.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path).select("path")
    partitioned = not files.filter(F.col("path").rlike("/[^/=]+=[^/]*/[^/]+$")).isEmpty()
    return spark.read.option("recursiveFileLookup", not partitioned).option("pathGlobFilter", "*.parquet").parquet(path)
