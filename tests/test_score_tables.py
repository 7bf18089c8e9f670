"""Stored score tables: lookups equal the plain join, read few parts and do not shuffle the score side."""

import gzip
import os

from helpers import call, calls, raw_annotation, records
from variantloom import jobs
from variantloom.operators.annotations import reshape_annotation, score_lookup
from variantloom.sinks import tables as W
from variantloom.sources.annotations import read_annotation_table
from variantloom.sources.score_tables import store_scores, stored_score_lookup

SCORES = "CHROM string, POS int, REF string, ALT string, Feature string, am_class string, am_pathogenicity double"
VARIANTS = "ID string, CHROM string, POS int, REF string, ALT string, Feature string"


def tables(spark):
    scores = [(f"chr{c}", p, "A", a, f"T{t}.{c}", "x", p / 100) for c in (1, 2) for p in range(0, 400, 7) for a in "CG" for t in range(3)]
    scores += [scores[0], (None, 1, "A", "C", "T0", "x", 1.0), ("chr1", 7, "A", "C", None, "x", 1.0), ("chr1_alt", 7, "A", "C", "T0", "x", 1.0)]
    variants = [(f"v{p}", "chr1", p, "A", "C", f"T{p % 4}.9") for p in range(0, 120, 5)] + [
        ("alt", "chr1_alt", 7, "A", "C", "T0.1"), ("gone", "chr9", 7, "A", "C", "T0"), ("null", None, 7, "A", "C", "T0"), ("none", "chr1", 7, "A", "C", None)]
    return spark.createDataFrame(scores, SCORES), spark.createDataFrame(variants, VARIANTS)


def test_lookup_equals_the_plain_join(spark, tmp_path):
    scores, variants = tables(spark)
    for by_transcript in (False, True):
        path = f"{tmp_path}/{by_transcript}"
        stored = scores if by_transcript else scores.drop("Feature")
        store_scores(stored, path, by_transcript, buckets=4, part_bp=100)
        plain = score_lookup(variants, stored, by_transcript)
        assert records(stored_score_lookup(variants, path), *plain.columns) == records(plain)


def test_lookup_prunes_parts_and_leaves_scores_unshuffled(spark, tmp_path):
    scores, variants = tables(spark)
    store_scores(scores, f"{tmp_path}/s", True, buckets=16, part_bp=100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stored_score_lookup(variants.filter("POS < 100"), f"{tmp_path}/s")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "chr1_0" in plan.split("PartitionFilters")[1] and "chr2_0" not in plan


def test_a_table_may_be_stored_again(spark, tmp_path):
    scores, variants = tables(spark)
    store_scores(scores, f"{tmp_path}/it's", True, buckets=4, part_bp=100)
    assert stored_score_lookup(variants, f"{tmp_path}/it's").filter("am_class IS NOT NULL").count() > 0
    store_scores(scores.limit(0), f"{tmp_path}/it's", True, buckets=2, part_bp=50)
    again = stored_score_lookup(variants, f"{tmp_path}/it's")
    assert again.count() == variants.count() and again.filter("am_class IS NOT NULL").count() == 0
    assert stored_score_lookup(variants.limit(0), f"{tmp_path}/it's").count() == 0


def gz(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as file:
        file.write(text)


def test_jobs_from_score_files_to_plugin_tables(spark, tmp_path):
    d = str(tmp_path)
    W.write_calls(calls(spark, call(), call("S2"), call(pos=200), call(chrom="chr2", pos=5)), f"{d}/calls")
    key = {"Location": "chr1:100", "Allele": "G", "Gene": "G1"}
    default = raw_annotation(spark, "default", *[{**key, "Uploaded_variation": i, "Feature": f} for i, f in (
        ("chr1_100_A_G", "ENST1"), ("chr1_100_A_G", "ENST2"), ("chr1_200_A_G", "ENST1"))])
    W.write_annotation_table(reshape_annotation(default, "default"), f"{d}/default")
    gz(f"{d}/in/am.tsv.gz", "# c\n#CHROM\tPOS\nchr1\t100\tA\tG\thg38\tP1\tENST1.7\tM1V\t0.9\tlikely_pathogenic\nchr1\t200\tA\tT\thg38\tP1\tENST1.7\tM1V\t0.1\tbenign\n")
    gz(f"{d}/in/splice.vcf.gz", "##x\nchr1\t100\t.\tA\tG\t.\t.\tSpliceAI=G|SYM|0.1|0.2|0.3|0.9|1|2|3|4,G|OTH|0|0|0|0|1|2|3|4\n")
    jobs.main(["scores", "alphamissense", f"{d}/in/am.tsv.gz", f"{d}/am", "--buckets", "4"], spark)
    jobs.main(["scores", "spliceai", f"{d}/in/splice.vcf.gz", f"{d}/splice", "--buckets", "4"], spark)
    for plugin, stored in (("alphamissense", "am"), ("spliceai", "splice")):
        jobs.main(["lookup", plugin, f"{d}/calls", f"{d}/default", f"{d}/{stored}", f"{d}/{plugin}"], spark)
    found = read_annotation_table(spark, f"{d}/alphamissense", "alphamissense")
    assert records(found, "ID", "Feature", "am_class", "am_pathogenicity", "ID_variant_gene", "Chr") == [
        ("chr1_100_A_G", "ENST1", "likely_pathogenic", 0.9, "chr1:100:G:G1:ENST1", "chr1")]
    found = read_annotation_table(spark, f"{d}/spliceai", "spliceai")
    assert records(found, "Feature", "SYMBOL", "DS_DL") == [("ENST1", "OTH", "0"), ("ENST1", "SYM", "0.9"), ("ENST2", "OTH", "0"), ("ENST2", "SYM", "0.9")]


def test_files_follow_the_rows_and_not_the_parts(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('chr', id % 2) CHROM", "CAST(id * 10 AS INT) POS", "'A' REF", "'C' ALT", "id / 2 AS score")
    store_scores(rows, f"{tmp_path}/few", buckets=4, part_bp=100)  # 400 parts
    store_scores(rows, f"{tmp_path}/cut", buckets=4, part_bp=100, file_rows=50)
    variants = spark.createDataFrame([("v", "chr1", 15010, "A", "C"), ("none", "chr1", 15015, "A", "C"), ("off", "chr3", 10, "A", "C")], VARIANTS.replace(", Feature string", ""))
    for name, folders in (("few", 2), ("cut", 10)):
        assert len([f for f in os.listdir(f"{tmp_path}/{name}") if f.startswith("_part=")]) == folders
        found = stored_score_lookup(variants, f"{tmp_path}/{name}")
        assert records(found, "ID", "score") == [("none", None), ("off", None), ("v", 750.5)]
        assert records(stored_score_lookup(rows.drop("score"), f"{tmp_path}/{name}"), *rows.columns) == records(rows)
    assert "chr1_120)" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]  # its first part
