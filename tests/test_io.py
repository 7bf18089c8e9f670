import glob
import gzip
import os

from helpers import call, calls, raw_annotation, records
from pyspark.sql import functions as F
from variantloom import jobs
from variantloom.operators.calls import normalize_calls
from variantloom.schemas import ENTRIES, UNFILTERED, VCF_HEADER, annotation_columns
from variantloom.sinks import tables as W
from variantloom.sinks.text import write_call_tsvs, write_sites
from variantloom.sources.annotations import header_columns, read_annotation_tsvs
from variantloom.sources.calls import read_call_tsvs, read_calls, read_unfiltered
from variantloom.sources.matrix import read_entries
from variantloom.sources.scores import read_alphamissense_scores, read_spliceai_scores
from variantloom.streaming.ingest import append_new_call_files

HEADER = "CHROM\tPOS\tREF\tALT\tGT\tDP\tAD\tGQ\n"


def _gz(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)
    return str(path)


def test_call_tsvs(spark, tmp_path):
    _gz(f"{tmp_path}/b1/S 1+x.tsv.gz", HEADER + "chr1\t5\tA\tG\t0/1\t20\t12,8\t50\nchr1\t6\tA\tG\t0/1\t-\t15\tbad\n")
    _gz(f"{tmp_path}/b2/deep/S2.tsv.gz", HEADER + "chr2\t7\tA\tT\t1/1\t9\t0,9\t40\n")
    _gz(f"{tmp_path}/b2/empty.tsv.gz", HEADER)
    _gz(f"{tmp_path}/b2/other.vcf.gz", "not\ta call file\n")
    got = normalize_calls(read_call_tsvs(spark, str(tmp_path)))
    assert records(got, "SampleID", "POS", "DP", "GQ", "REF_AD", "ALT_AD") == sorted(
        [("S 1+x", 5, 20, 50, 12, 8), ("S 1+x", 6, None, None, 15, None), ("S2", 7, 9, 40, 0, 9)], key=str)


def test_call_tsv_round_trip_and_stream(spark, tmp_path):
    rows = calls(spark, call(), call("S:2/x", pos=7), call("S3", dp=None))
    raw = rows.withColumn("AD", F.concat_ws(",", F.col("REF_AD").cast("string"), F.col("ALT_AD").cast("string")))
    write_call_tsvs(raw, f"{tmp_path}/tsv")
    assert records(normalize_calls(read_call_tsvs(spark, f"{tmp_path}/tsv"))) == records(rows)
    for _ in range(2):
        append_new_call_files(spark, f"{tmp_path}/tsv", f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination()
    assert records(spark.read.parquet(f"{tmp_path}/table").select(*rows.columns)) == records(rows)
    write_call_tsvs(raw.limit(1).withColumn("SampleID", F.lit("late")), f"{tmp_path}/tsv", mode="append")
    append_new_call_files(spark, f"{tmp_path}/tsv", f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/table").count() == 4


def test_calls_table_prunes_and_merges(spark, tmp_path):
    W.write_calls(calls(spark, call(), call(chrom="chr2")), f"{tmp_path}/a")
    W.append_calls(calls(spark, call("S2")), f"{tmp_path}/b")
    W.append_calls(calls(spark, call("S3")), f"{tmp_path}/b")
    jobs.main(["merge", f"{tmp_path}/b,{tmp_path}/b", f"{tmp_path}/m"], spark)
    assert read_calls(spark, f"{tmp_path}/m").count() == 4
    one = read_calls(spark, f"{tmp_path}/a").filter("CHROM = 'chr2'")
    assert "PartitionFilters: [isnotnull(CHROM" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_sites_files_are_sorted_and_headed(spark, tmp_path):
    rows = calls(spark, *[call(pos=p, chrom=c) for c in ("chr1", "chr2") for p in (30_000_000, 5, 12_000_000, 200)])
    from variantloom.operators.sites import vcf_rows

    write_sites(vcf_rows(rows), f"{tmp_path}/shards")
    write_sites(vcf_rows(rows), f"{tmp_path}/whole", shard_bp=None, compression="none")
    shards = glob.glob(f"{tmp_path}/shards/CHROM=*/shard=*/*.gz")
    assert len(shards) == 6
    for path in shards:
        text = gzip.open(path, "rt").read().splitlines()
        assert "\n".join(text[:2]) == VCF_HEADER
        assert len(text) > 2
    whole = glob.glob(f"{tmp_path}/whole/CHROM=chr1/shard=0/*.txt")
    assert len(whole) == 1
    lines = open(whole[0]).read().splitlines()
    assert "\n".join(lines[:2]) == VCF_HEADER
    assert [line.split("\t")[1] for line in lines[2:]] == ["5", "200", "12000000", "30000000"]
    assert lines[2] == "chr1\t5\tchr1_5_A_G\tA\tG\t.\tPASS\t."


def test_sites_shards_of_even_size(spark, tmp_path):
    # 900 sites in one stretch of 300 kb, 100 thin ones over the rest of a chromosome
    dense = [call(pos=1_000_000 + 333 * i) for i in range(900)]
    thin = [call(pos=5_000_000 + 1_000_000 * i) for i in range(100)]
    from variantloom.operators.sites import vcf_rows

    rows = calls(spark, *dense, *thin, call(chrom="chr2"))
    write_sites(vcf_rows(rows), f"{tmp_path}/even", shard_rows=100)
    kept = {}
    for path in glob.glob(f"{tmp_path}/even/CHROM=*/shard=*/*.gz"):
        text = gzip.open(path, "rt").read().splitlines()
        assert "\n".join(text[:2]) == VCF_HEADER
        key = tuple(part.split("=")[1] for part in path.split("/")[-3:-1])
        assert key not in kept
        kept[key] = [int(line.split("\t")[1]) for line in text[2:]]
    shards = [kept["chr1", str(i)] for i in range(len(kept) - 1)]
    # at most a stretch of 10 kb (31 sites here) too long, and shard by shard in order of the chromosome
    assert max(map(len, shards)) <= 131 and len(shards) == 10
    assert sum(shards, []) == [1_000_000 + 333 * i for i in range(900)] + [5_000_000 + 1_000_000 * i for i in range(100)]
    assert kept["chr2", "0"] == [100]


def test_sites_shards_number_without_gaps(spark):
    # a stretch of more rows than three shards, then a single site
    from variantloom.sinks.text import shards_by_size

    df = spark.createDataFrame([("chr1", p) for p in [*range(35), 20_000, 40_000]], "CHROM string, POS int")
    got = sorted(tuple(r) for r in shards_by_size(df, 10).groupBy("shard").count().collect())
    assert got == [(0, 35), (1, 2)]


def test_matrix_job_reads_wide_rows_one_at_a_time(spark, tmp_path):
    # 3 variants, 20,000 samples each, most without the allele
    spark.range(3).selectExpr(
        "named_struct('contig', 'chr1', 'position', CAST(id AS int)) AS locus", "array('A', 'G') AS alleles",
        "transform(sequence(1, 20000), i -> named_struct('s', concat('S', i), 'GT', named_struct('alleles', array(0, CAST(i % 100 = id AS int)), "
        "'phased', false), 'AD', array(10, i % 7), 'GQ', 50)) AS entries").write.parquet(f"{tmp_path}/matrix")
    setting = "spark.sql.parquet.enableNestedColumnVectorizedReader"
    before = spark.conf.get(setting)
    try:
        jobs.main(["matrix", f"{tmp_path}/matrix", f"{tmp_path}/calls"], spark)
        plan = read_entries(spark, f"{tmp_path}/matrix")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "Batched: false" in plan
    got = read_calls(spark, f"{tmp_path}/calls")
    assert records(got.groupBy("POS").agg(F.count("*").alias("n"), F.sum("DP").alias("dp"))) == [
        (p, 200, 2000 + sum(i % 7 for i in range(1, 20001) if i % 100 == p)) for p in range(3)]


def test_annotator_files(spark, tmp_path):
    columns = annotation_columns("loftee")
    body = "chr1_5_A_G\tchr1:5\t-\t-\tT1\tHC\t-\t-\tx\n"
    path = _gz(f"{tmp_path}/in/chr1.tsv.gz", "## tool\n## more\n#" + "\t".join(columns) + "\n" + body)
    _gz(f"{tmp_path}/in/chrX.tsv.gz", "## tool\n#" + "\t".join(columns) + "\n" + body.replace("chr1", "chrX"))
    assert header_columns(spark, path) == columns
    got = read_annotation_tsvs(spark, f"{tmp_path}/in", "loftee")
    assert records(got, "Chr", "Uploaded_variation", "Allele", "Gene", "LoF", "LoF_filter", "LoF_info") == [
        ("chr1", "chr1_5_A_G", None, None, "HC", None, "x"), ("chrX", "chrX_5_A_G", None, None, "HC", None, "x")]
    os.makedirs(f"{tmp_path}/none")
    nothing = read_annotation_tsvs(spark, f"{tmp_path}/none", "loftee")
    assert nothing.count() == 0 and nothing.columns == columns + ["Chr"]


def test_score_files(spark, tmp_path):
    am = _gz(f"{tmp_path}/am.tsv.gz", "# note\n#CHROM\tPOS\nchr1\t5\tA\tG\thg38\tP1\tT1.1\tV2L\t0.29\tlikely_benign\n")
    assert records(read_alphamissense_scores(spark, am)) == [("chr1", 5, "A", "G", "T1.1", "likely_benign", 0.29)]
    sp = _gz(f"{tmp_path}/s.vcf.gz", "##x\n#CHROM\nchr1\t5\t.\tA\tG\t.\t.\tSpliceAI=G|AA|0.1|0|0|0|1|2|3|4,G|BB|0.2|0|0|0|5|6|7|8\n")
    assert records(read_spliceai_scores(spark, sp), "ALT", "SYMBOL", "DS_AG", "DP_DL") == [("G", "AA", "0.1", "4"), ("G", "BB", "0.2", "8")]


def _gvcf(rows):
    return "##fileformat=VCFv4.2\n#CHROM\tPOS\n" + "".join(
        f"chr1\t{p}\t.\tA\t{alt},<NON_REF>\t.\tPASS\t.\tGT:AD:DP:GQ\t{gt}:{ad}\n" for p, alt, gt, ad in rows)


def test_whole_flow_from_files(spark, tmp_path):
    d = str(tmp_path)
    for s, rows in {"A": [(5, "G", "0/1", "20,20,0:40:60"), (6, "T", "0/0", "40,0,0:40:60")],
                    "B": [(5, "G", "0/1", "10,20,0:30:60"), (9, "C", "0/1", "15,15,0:30:50")]}.items():
        _gz(f"{d}/gvcf/{s}.gvcf.gz", _gvcf(rows))
    _gz(f"{d}/manifest.tsv.gz", f"sampleID\tPath\nA\t/x/A.gvcf.gz\nB\t/x/B.gvcf.gz\n")
    with open(f"{d}/g.fa", "w") as f:
        f.write(">chr1\n" + "A" * 50 + "\n")
    with open(f"{d}/g.fa.fai", "w") as f:
        f.write("chr1\t50\t6\t60\t61\n")
    jobs.main(["batches", f"{d}/manifest.tsv.gz", f"{d}/batches", "--size", "1"], spark)
    assert records(spark.read.parquet(f"{d}/batches"), "sampleID", "batch") == [("A", 0), ("B", 1)]
    jobs.main(["reference", f"{d}/g.fa", f"{d}/g.fa.fai", f"{d}/blocks"], spark)
    jobs.main(["extract", f"{d}/manifest.tsv.gz", f"{d}/gvcf", f"{d}/tsv", "--blocks", f"{d}/blocks"], spark)
    jobs.main(["shared", f"{d}/tsv", f"{d}/tsv", f"{d}/tsv2"], spark)
    jobs.main(["calls", f"{d}/tsv2", f"{d}/calls"], spark)
    assert records(read_calls(spark, f"{d}/calls"), "SampleID", "ID", "REF_AD") == [
        ("A", "chr1_5_A_G", 20), ("B", "chr1_5_A_G", 10), ("B", "chr1_9_A_C", 15)]
    jobs.main(["genotypes", f"{d}/calls", f"{d}/gt"], spark)
    jobs.main(["sites", f"{d}/calls", f"{d}/sites", "--counts", f"{d}/counts"], spark)
    assert records(spark.read.parquet(f"{d}/counts")) == [("all", 2), ("chr1", 2)]
    for plugin, payload in {"default": {"Consequence": "missense_variant", "CANONICAL": "YES"}, "loftee": {},
                            "alphamissense": {"am_pathogenicity": "0.9"}, "spliceai": {"SpliceAI_pred": "S|0.1|0|0|0|1|2|3|4"}}.items():
        columns = annotation_columns(plugin)
        key = {"Uploaded_variation": "chr1_5_A_G", "Location": "chr1:5", "Allele": "G", "Gene": "G1", "Feature": "T1", **payload}
        path = _gz(f"{d}/vep/{plugin}/chr1.tsv.gz", "#" + "\t".join(columns) + "\n" + "\t".join(key.get(c, "-") for c in columns) + "\n")
        jobs.main(["convert", plugin, f"{d}/vep/{plugin}", f"{d}/{plugin}", "--header-file", path], spark)
    jobs.main(["integrate", f"{d}/calls", f"{d}/default", f"spliceai={d}/spliceai,alphamissense={d}/alphamissense,loftee={d}/loftee", f"{d}/unfiltered",
               "--coverage", f"{d}/coverage"], spark)
    table = read_unfiltered(spark, f"{d}/unfiltered")
    assert sorted(table.columns) == sorted(UNFILTERED.fieldNames()) and dict(table.dtypes) == dict(spark.read.parquet(f"{d}/unfiltered").dtypes)
    assert len(table.columns) == 34 and table.count() == 2
    assert records(spark.read.parquet(f"{d}/coverage"), "CHROM", "shared", "calls_only", "annotation_only") == [("chr1", 1, 1, 0)]
    jobs.main(["curate", f"{d}/unfiltered", f"{d}/report", f"{d}/curated", "--others", f"{d}/others"], spark)
    curated = spark.read.parquet(f"{d}/curated")
    assert records(curated, "SampleID", "dataset_AF", "Variant_Type", "am_pathogenicity", "Max_DS_SpliceAI") == [
        ("A", 0.5, "Missense", 0.9, 0.1), ("B", 0.5, "Missense", 0.9, 0.1)]
    report = [r["value"] for r in spark.read.text(f"{d}/report").collect()]
    assert report[0] == "chr1\tinput\tpairs\t2" and "chr1\tvariant types after impact filter\tMissense\t2" in report
    jobs.main(["curate", f"{d}/unfiltered", f"{d}/report2", f"{d}/curated2", "--contigs", "canonical", "--min-dp", "35"], spark)
    assert records(spark.read.parquet(f"{d}/curated2"), "SampleID") == [("A",)]
    jobs.main(["cohort", f"{d}/calls", f"{d}/default", f"spliceai={d}/spliceai,alphamissense={d}/alphamissense,loftee={d}/loftee",
               f"{d}/report3", f"{d}/curated3"], spark)
    assert records(spark.read.parquet(f"{d}/curated3"), *curated.columns) == records(curated)
    assert [r["value"] for r in spark.read.text(f"{d}/report3").collect()] == report
    jobs.main(["profile", f"{d}/curated", f"{d}/profile", "--table", "curated"], spark)
    assert spark.read.parquet(f"{d}/profile/histogram").count() > 0


def test_matrix_job(spark, tmp_path):
    row = (("chr1", 9), ["A", "G"], [("a", ([0, 1], True), [3, 4], 50), ("b", ([0, 0], False), [9, 0], 50)])
    spark.createDataFrame([row], ENTRIES).write.parquet(f"{tmp_path}/mt")
    jobs.main(["matrix", f"{tmp_path}/mt", f"{tmp_path}/calls"], spark)
    assert records(read_calls(spark, f"{tmp_path}/calls"), "SampleID", "GT", "ID") == [("a", "0/1", "chr1_9_A_G")]


def test_rebalanced_writes_cut_a_hot_variant(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    rows = spark.range(0, 40_000, 1, 8).selectExpr(
        "concat('S', id) AS SampleID", "'chr1' AS CHROM", "5 AS POS", "'A' AS REF", "'G' AS ALT", "'0/1' AS GT", "1 AS DP", "1 AS GQ",
        "1 AS REF_AD", "1 AS ALT_AD", "'chr1_5_A_G' AS ID")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        W.write_calls(rows, f"{tmp_path}/c")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(glob.glob(f"{tmp_path}/c/CHROM=chr1/*.parquet")) > 1
    assert read_calls(spark, f"{tmp_path}/c").distinct().count() == 40_000


def test_unfiltered_files_do_not_grow_with_tasks(spark, tmp_path):
    rows = spark.range(0, 4_800, 1, 16).selectExpr(
        "concat('chr', 1 + id % 24) AS CHROM", "CAST(1 + id * 500 AS INT) AS POS", "'A' AS REF", "'G' AS ALT",
        "concat('T', id % 7) AS Feature", "concat('S', id) AS SampleID")
    W.write_unfiltered(rows, f"{tmp_path}/u")
    # straight from 16 tasks it would be 16 x 24 files
    assert len(glob.glob(f"{tmp_path}/u/CHROM=*/*.parquet")) <= 48
    assert records(spark.read.parquet(f"{tmp_path}/u"), *rows.columns) == records(rows)
