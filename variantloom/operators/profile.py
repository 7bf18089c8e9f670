"""Column profiles: histograms of numeric columns and the most frequent values of the others."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantloom.session import ensure_checkpoint_dir

_NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def numeric_columns(df):
    return [f.name for f in df.schema if isinstance(f.dataType, _NUMERIC)]


def categorical_columns(df):
    """String, boolean and string-list columns."""
    def listed(kind):
        return isinstance(kind, (T.StringType, T.BooleanType)) or (
            isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType))

    return [f.name for f in df.schema if listed(f.dataType)]


def _unpivot(df, columns, kind):
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(kind).alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def histogram(df, bins=50, columns=None):
    """``column, bin, bin_start, n, min_value, max_value`` for all numeric columns at once.

    The bin is ``floor((x - min) / width)`` with width ``(max - min) / bins``, or 1 for a constant
    column, so the maximum lands in bin ``bins``. Nulls are skipped, as are all-null columns.
    """
    columns = columns or numeric_columns(df)
    values = _unpivot(df, columns, "double").filter(F.col("value").isNotNull())
    ranges = values.groupBy("column").agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    step = (F.col("max_value") - F.col("min_value")) / F.lit(float(bins))
    width = F.when(step == 0, F.lit(1.0)).otherwise(step)
    # one row per column of the schema: small whatever the data
    located = values.join(F.broadcast(ranges), "column").withColumn(
        "bin", F.floor((F.col("value") - F.col("min_value")) / width))
    return (
        located.groupBy("column", "bin", "min_value", "max_value").agg(F.count("*").alias("n"))
        .select("column", "bin",
                (F.col("min_value") + F.col("bin") * (F.col("max_value") - F.col("min_value")) / F.lit(float(bins)))
                .alias("bin_start"),
                "n", "min_value", "max_value")
        .orderBy("column", "bin")
    )


def top_values(df, k=20, columns=None):
    """``column, value, n, rank``: the ``k`` most frequent values per column; null counts as a value.

    Values are counted first. Spark limits ranks within each task before the shuffle while ``k`` is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold``; then a column with very many values (sample, variant) sends
    ``k`` rows per task. Beyond, no task sorts a column: see :func:`_top_by_range`. Ties go by value.
    """
    counts = _unpivot(df, columns or categorical_columns(df), "string").groupBy("column", "value").agg(
        F.count("*").alias("n"))
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return _top_by_range(counts, k)
    return counts.withColumn("rank", F.row_number().over(_order("column"))).filter(F.col("rank") <= k)


def _order(*keys):
    return Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc_nulls_last("value"))


def _top_by_range(counts, k):
    """Ranks of the first ``k`` counts per column, sorted by ranges.

    How many values share a count gives a column's least count that can still rank. What is left is dealt by ranges of
    column, count and value; a range starts after the rows of the column in the ranges before it, and those that start
    beyond ``k`` are dropped before anything is sorted. A range is cut by sampled quantiles, whatever ``k`` and the ties.
    """
    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint()
    # a column of N rows has fewer than sqrt(2 N) different counts
    before = Window.partitionBy("column").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    least = (
        counts.groupBy("column", "n").agg(F.count("*").alias("_values"))
        .withColumn("_before", F.coalesce(F.sum("_values").over(before), F.lit(0))).filter(F.col("_before") < k)
        .groupBy("column").agg(F.min("n").alias("_least"))
    )
    kept = counts.join(least, "column").filter(F.col("n") >= F.col("_least")).drop("_least")
    # stored, so that a row's range is the same for both readers
    dealt = kept.repartitionByRange("column", F.desc("n"), F.asc_nulls_last("value")).withColumn(
        "_range", F.spark_partition_id()).checkpoint()
    ranges = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("column", "_range").agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(ranges), F.lit(0))).filter(F.col("_start") < k)
        .select("column", "_range", "_start")
    )
    ranked = dealt.join(starts, ["column", "_range"]).withColumn(
        "rank", (F.col("_start") + F.row_number().over(_order("column", "_range"))).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("column", "value", "n", "rank")
