"""Call files added to the calls table as they arrive."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.operators.calls import normalize_calls
from variantloom.schemas import CALL_TSV
from variantloom.sinks.batches import stream_batch, write_batch
from variantloom.sources.calls import CALL_FILES, sample_from_path


def holds_other_data(spark, table):
    """The folder has files or folders, but no log of a streaming sink."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return False
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return bool(names) and "_spark_metadata" not in names


def append_new_call_files(spark, source, table, checkpoint, files_per_trigger=10_000):
    """Start a run that appends every file not seen before and then ends.

    The checkpoint remembers the files, so a run that was cut short or repeated adds each once.
    Normalising is row by row: no state is kept. Returns the streaming query. The table must be this stream's
    own: the sink's log hides files that it did not write, so a folder with other data is refused.
    """
    if holds_other_data(spark, table):
        raise ValueError(f"{table} holds data that was not written by this stream; stream into a folder of its own")
    return (
        new_calls(spark, source, files_per_trigger).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", table)
        .trigger(availableNow=True).start()
    )


def new_calls(spark, source, files_per_trigger):
    """Stream of the calls in files below ``source``."""
    return normalize_calls(
        spark.readStream.schema(CALL_TSV)
        .option("sep", "\t").option("header", True).option("nullValue", "-").option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", CALL_FILES)
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(source)
        .withColumn("SampleID", sample_from_path(F.col("_metadata.file_path")))
    )


def append_batches(spark, source, table, checkpoint, stream="stream", files_per_trigger=10_000):
    """As :func:`append_new_call_files`, into a table of batches that other jobs write to as well.

    A micro-batch is one batch of the table, named by ``stream`` and its number. If it is replayed after a failure it is
    written anew under the same name, so each file counts once. Streams into one table have names of their own.
    """
    def write(calls, batch_id):
        write_batch(calls, table, stream_batch(stream, batch_id))

    return (
        new_calls(spark, source, files_per_trigger).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
