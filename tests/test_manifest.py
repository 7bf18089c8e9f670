import gzip

from helpers import records
from variantloom.operators import manifest as M
from variantloom.sources.gvcf import attach_samples
from variantloom.sources.manifest import read_manifest, read_sample_list


def _manifest(spark, n):
    return spark.range(n).selectExpr("concat('S', id) AS sampleID", "concat('/d/S', id, '.gvcf.gz') AS Path", "id AS line")


def test_batches_keep_remainder_and_limit(spark):
    got = M.assign_batches(_manifest(spark, 150).repartition(7), size=64)
    assert {r["batch"]: r["count"] for r in got.groupBy("batch").count().collect()} == {0: 64, 1: 64, 2: 22}
    assert all(r["batch"] == r["line"] // 64 for r in got.collect())
    assert M.assign_batches(_manifest(spark, 150), size=64, max_batches=1).count() == 64


def test_numbering_crosses_buckets_and_gaps(spark, monkeypatch):
    monkeypatch.setattr(M, "_BUCKET", 10)
    lines = spark.range(95).selectExpr("id", "CASE WHEN id < 50 THEN id ELSE id + 1000003 END AS line")
    got = M.number_rows(lines).collect()
    assert all(r["rn"] == r["id"] + 1 and r["total"] == 95 for r in got)


def test_split_is_ceil_of_total(spark):
    got = M.split_batches(_manifest(spark, 10), 4, start=5).groupBy("batch").count()
    assert records(got) == [(5, 3), (6, 3), (7, 3), (8, 1)]


def test_resolve_and_pair(spark):
    rows = [("a", "/x/a.gatk.gz", 0), ("a", "/x/a.deepvariant.gz", 1), ("b", "/y/b.gatk.gz", 2), ("a", "/z/a.gatk.gz", 3)]
    manifest = spark.createDataFrame(rows, "sampleID string, Path string, line bigint")
    staged = spark.createDataFrame([("a.deepvariant.gz",), ("a.gatk.gz",), ("a.gatk.gz",), ("b.gatk",)], "file string")
    assert records(M.resolve_files(manifest, staged), "sampleID", "file") == [("a", "a.gatk.gz")]
    assert records(M.pair_callsets(manifest), "sampleID", "gatk", "deepvariant") == [
        ("a", "/x/a.gatk.gz", "/x/a.deepvariant.gz"), ("b", "/y/b.gatk.gz", None)]


def test_readers_keep_file_order(spark, tmp_path):
    path = str(tmp_path / "m.tsv.gz")
    with gzip.open(path, "wt") as f:
        f.write("sampleID\tPath\n" + "".join(f"S{i}\t /d/S{i}.gvcf.gz\n" for i in range(5)))
    assert [tuple(r)[:2] for r in read_manifest(spark, path).orderBy("line").collect()] == [(f"S{i}", f"/d/S{i}.gvcf.gz") for i in range(5)]
    with open(tmp_path / "s.txt", "w") as f:
        f.write("b\na\n\nc\n")
    assert [r["sampleID"] for r in read_sample_list(spark, str(tmp_path / "s.txt")).orderBy("line").collect()] == ["b", "a", "c"]


def test_attach_samples_by_base_name(spark):
    manifest = spark.createDataFrame([("A", "/far/one.gvcf.gz", 0), ("B", "/far/two+x.gvcf.gz", 1)], "sampleID string, Path string, line int")
    rows = spark.createDataFrame([("file:/near/one.gvcf.gz", 1), ("file:/near/two+x.gvcf.gz", 2), ("file:/near/other.gz", 3)], "path string, v int")
    assert records(attach_samples(rows, manifest), "SampleID", "v") == [("A", 1), ("B", 2)]
