"""A calls table that grows by batches, each a folder that is replaced as a whole.

``batch=<name>`` folders hold a batch each and count from the moment their ``_SUCCESS`` file is there. A batch that is
written again takes the place of its first attempt, so a job may be repeated at any point. Batches from
jobs and from streams stand side by side. A compacted batch carries the names of those it replaces: readers leave
these out, whether they have been deleted yet or not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import types as T

from variantloom.functions.text import literal_path
from variantloom.schemas import CALLS

REPLACES = "_replaces"


def _files(spark, path):
    """Hadoop's file system of a path, and a function that makes its paths."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def batch_folder(table, batch):
    if not batch or batch.strip(". ") == "" or any(c in batch for c in "/\\=%:*?[]{}"):
        raise ValueError(f"not a batch name: {batch!r}")
    return f"{table}/batch={batch}"


def write_batch(calls, table, batch):
    """Write a batch, or write it anew. The clustering of rows is done when batches are compacted."""
    calls.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("CHROM").parquet(batch_folder(table, batch))


def committed_batches(spark, table):
    """Names of the batches that are complete and not replaced by a compacted one: a listing, no data is read."""
    files, path = _files(spark, table)
    if not files.exists(path(table)):
        return []
    folders = [s.getPath() for s in files.listStatus(path(table)) if s.isDirectory() and s.getPath().getName().startswith("batch=")]
    complete = {f.getName().removeprefix("batch="): f for f in folders if files.exists(path(f, "_SUCCESS"))}
    replaced = set()
    for folder in complete.values():
        if files.exists(path(folder, REPLACES)):
            replaced.update(s.getPath().getName() for s in files.listStatus(path(folder, REPLACES)))
    return sorted(set(complete) - replaced)


def read_batches(spark, table, batches=None):
    """Rows of the complete batches, or of those named."""
    names = committed_batches(spark, table) if batches is None else batches
    if not names:
        return spark.createDataFrame([], CALLS)
    schema = T.StructType([*CALLS.fields, T.StructField("batch", T.StringType())])
    paths = [literal_path(batch_folder(table, name)) for name in names]
    return spark.read.schema(schema).option("basePath", table).parquet(*paths).select(*CALLS.names)


def compact(spark, table, name, write, merge):
    """Put all complete batches into the one called ``name``, merged by ``merge`` and written by ``write(rows, path)``.

    The new batch is built aside, given the names of those it replaces, and moved into place by one rename. Only then are
    the replaced folders deleted. Returns the replaced names.
    """
    old = committed_batches(spark, table)
    if name in old:
        raise ValueError(f"there is a batch called {name}")
    if not old:
        return []
    files, path = _files(spark, table)
    aside = f"{table}/_compact-{uuid.uuid4().hex}"
    write(merge(read_batches(spark, table, old)), aside)
    for batch in old:
        files.create(path(f"{aside}/{REPLACES}/{batch}"), True).close()
    target = path(batch_folder(table, name))
    files.delete(target, True)  # of an attempt that was not completed
    if not files.rename(path(aside), target):
        raise OSError(f"{aside} could not be moved to {target}")
    drop_replaced(spark, table)
    return old


def drop_replaced(spark, table):
    """Delete the folders that compacted batches replace; may be repeated."""
    files, path = _files(spark, table)
    for name in committed_batches(spark, table):
        mark = path(f"{batch_folder(table, name)}/{REPLACES}")
        for status in files.listStatus(mark) if files.exists(mark) else []:
            files.delete(path(batch_folder(table, status.getPath().getName())), True)


def is_batch_table(spark, table):
    files, path = _files(spark, table)
    return files.exists(path(table)) and any(s.getPath().getName().startswith("batch=") for s in files.listStatus(path(table)))


def read_calls_table(spark, table):
    """A calls table, whether it was written at once or by batches."""
    return read_batches(spark, table) if is_batch_table(spark, table) else spark.read.schema(CALLS).parquet(table)


def stream_batch(stream, batch_id):
    """Batch name of a stream's micro-batch: the same when it is replayed."""
    return f"{stream}-{batch_id:012d}"

