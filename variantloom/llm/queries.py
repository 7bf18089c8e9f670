"""Registered queries of the corpus operators, over the whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from variantloom.llm import bpe, centroids, embed_dedup, html_extract, langid, licenses, line_dedup, packing, prefix_trie, simhash, suffix_dedup, topk, toxicity
from variantloom.llm.common import fold


# The edits between near lines in the SQL of op10. The operator and the pipeline take two.
SQL_EDITS = 1


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_embed_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings")).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_html_extract(spark, sf_dir):
    texts = html_extract.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_simhash(spark, sf_dir):
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    model = langid.train(docs.filter("NOT held_out"))
    return langid.predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark, sf_dir):
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op10_line_dedup(spark, sf_dir):
    """Per document: lines taken out, and the digest and length of the text that is left."""
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=SQL_EDITS)
    return docs.select("doc_id", F.col("n_lines_removed").cast("long").alias("n_lines_removed"),
                       F.char_length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def toxicity_model(spark, sf_dir):
    """Learned from the rows whose fold of three is not 1."""
    taught = fold("doc_id", 3) != 1
    return toxicity.train(table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(taught),
                          table(spark, sf_dir, "documents").select("doc_id", "text").filter(taught))


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}
