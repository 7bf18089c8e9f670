"""Helpers the corpus operators share: row keys, folds, checkpoints and Arrow batches."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from variantloom.session import ensure_checkpoint_dir

# Rows of Arrow that one task hands back to Spark at a time.
OUT_ROWS = 512


def text_rows(docs, id_col="doc_id", text_col="text", null_text=""):
    """``doc_id`` and ``text`` alone, under these names whatever else ``docs`` holds."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       (text if null_text is None else F.coalesce(text, F.lit(null_text))).alias("text"))


def fold(column, parts):
    """``crc32(id as text) mod parts``; a null id is in fold -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(-1)).cast("int")


def stored(df):
    """Cut the lineage: rows are written to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df):
    """Cut the lineage by a Parquet table in the shared checkpoint folder: smaller than :func:`stored` for numbers that compress."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df):
    """Partition count of the session's shuffles."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def batches(rows, schema):
    """Cut a stream of tuples into Arrow batches of at most ``OUT_ROWS`` rows."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield columns_batch(zip(*held), schema)
            held = []
    if held:
        yield columns_batch(zip(*held), schema)


def columns_batch(columns, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
