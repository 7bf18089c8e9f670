"""Corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate group stays, repeated
passages go, and what is left is packed. Each stage takes the documents that the one before it returned.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from variantloom.llm import line_dedup, packing, simhash, suffix_dedup, toxicity
from variantloom.llm.common import fold

# Fitted classifiers and suffix ranges: no SQL.
ORACLE_SQL = None

# The shortest passage that is cut: 50 words of four letters with a blank each. The bytes of a gram mark its windows.
PASSAGE_BYTES, GRAM_BYTES = 250, 50


def measured(docs, columns):
    """``n_chars`` follows the text that is left; columns as in ``documents``."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def reject_toxic(spark, docs, sf_dir):
    """Learns from the labels of folds other than 1 of three; rejects what scores 0.7 or more."""
    taught = fold("doc_id", 3) != 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(taught)
    model = toxicity.train(labels, docs.select("doc_id", "text").filter(taught))
    return toxicity.without_toxic(docs, model)


def drop_repeated_lines(spark, docs, sf_dir):
    return measured(line_dedup.dedup_lines(docs, count_col=None), docs.columns)


def keep_one_of_each(spark, docs, sf_dir):
    return simhash.keep_one(docs)


def cut_repeated_passages(spark, docs, sf_dir):
    return measured(suffix_dedup.cut_repeats(docs, PASSAGE_BYTES, GRAM_BYTES), docs.columns)


def pack(spark, docs, sf_dir):
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", reject_toxic), ("line_dedup", drop_repeated_lines), ("simhash", keep_one_of_each),
          ("suffix_dedup", cut_repeated_passages), ("packing", pack)]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
