import gzip

import pytest
from pyspark.sql import functions as F

from variantloom.operators.annotations import score_lookup
from variantloom.sources.calls import read_call_tsvs, sample_from_path
from variantloom.sources.gvcf import attach_samples, gvcf_files, parse_gvcf, read_gvcf_lines, unlisted_files
from variantloom.streaming.ingest import append_new_call_files

LINE = "chr1\t{pos}\t.\tA\tG\t.\tPASS\t.\tGT:DP:AD:GQ\t0/1:30:15,15:50\n"


def gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as file:
        file.write(text)


def test_equal_base_names_keep_their_samples(spark, tmp_path):
    gz(tmp_path / "1/s.gvcf.gz", LINE.format(pos=1))
    gz(tmp_path / "2/s.gvcf.gz", LINE.format(pos=2) + "chr1\t3\t.\tA\tG\t.\tPASS\t.\n")
    manifest = spark.createDataFrame([("A", f"{tmp_path}/1/s.gvcf.gz"), ("B", f"{tmp_path}/2/s.gvcf.gz")], "sampleID string, Path string")
    rows = attach_samples(parse_gvcf(read_gvcf_lines(spark, str(tmp_path))), manifest).collect()
    assert sorted((r.SampleID, r.POS) for r in rows) == [("A", 1), ("B", 2)]


def test_a_moved_file_with_a_repeated_base_name_fails(spark, tmp_path):
    gz(tmp_path / "1/s.gvcf.gz", LINE.format(pos=1))
    manifest = spark.createDataFrame([("A", "/elsewhere/1/s.gvcf.gz"), ("B", "/elsewhere/2/s.gvcf.gz")], "sampleID string, Path string")
    with pytest.raises(Exception, match="listed more than once"):
        attach_samples(parse_gvcf(read_gvcf_lines(spark, str(tmp_path))), manifest).collect()


def test_files_not_listed_are_counted(spark, tmp_path):
    for name in ("1/a.gvcf.gz", "2/b.gvcf.gz", "3/c.gvcf.gz"):
        gz(tmp_path / name, LINE.format(pos=1))
    manifest = spark.createDataFrame([("A", f"{tmp_path}/1/a.gvcf.gz"), ("B", "/elsewhere/b.gvcf.gz")], "sampleID string, Path string")
    assert [r.path.rsplit("/", 1)[1] for r in unlisted_files(gvcf_files(spark, str(tmp_path)), manifest).collect()] == ["c.gvcf.gz"]


def test_sample_names_of_both_suffixes(spark):
    paths = spark.createDataFrame([("file:/x/S9.csv.gz",), ("file:/x/S8.tsv.gz",)], "p string")
    assert [r[0] for r in paths.select(sample_from_path(F.col("p"))).collect()] == ["S9", "S8"]
    with pytest.raises(Exception, match="no sample name"):
        spark.createDataFrame([("file:/x/.tsv.gz",)], "p string").select(sample_from_path(F.col("p"))).collect()


def test_a_swapped_header_fails(spark, tmp_path):
    gz(tmp_path / "S1.tsv.gz", "CHROM\tPOS\tREF\tALT\tGT\tDP\tGQ\tAD\nchr1\t1\tA\tG\t0/1\t30\t50\t15,15\n")
    with pytest.raises(Exception):
        read_call_tsvs(spark, str(tmp_path)).collect()


def test_a_stream_refuses_other_data(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/table")
    with pytest.raises(ValueError, match="folder of its own"):
        append_new_call_files(spark, str(tmp_path), f"{tmp_path}/table", f"{tmp_path}/state")


def test_transcripts_match_without_versions(spark):
    variants = spark.createDataFrame([("chr1", 1, "A", "G", "T1")], "CHROM string, POS int, REF string, ALT string, Feature string")
    scores = spark.createDataFrame([("chr1", 1, "A", "G", "T1.3", 0.5)], "CHROM string, POS int, REF string, ALT string, Feature string, s double")
    assert [(r.Feature, r.s) for r in score_lookup(variants, scores, match_feature=True).collect()] == [("T1", 0.5)]
