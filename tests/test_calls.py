from pyspark.sql import functions as F

from helpers import call, calls, records
from variantloom.operators import calls as K
from variantloom.operators import sites as S
from variantloom.schemas import CALL_COLUMNS, ENTRIES
from variantloom.sources.gvcf import parse_gvcf

RAW = "SampleID string, CHROM string, POS int, REF string, ALT string, GT string, DP int, AD string, GQ int"


def test_normalize_depths(spark):
    raw = spark.createDataFrame([
        ("S1", "chr1", 5, "A", "G", "0/1", 42, "12,30", 9), ("S1", "chr1", 6, "A", "G", "0/1", 15, "15", 9),
        ("S1", "chr1", 7, "A", "G", "0/1", 15, "x,3", 9), ("S1", "chr1", 8, "A", "G", "0/1", None, None, None)], RAW)
    out = K.normalize_calls(raw)
    assert out.columns == CALL_COLUMNS
    assert records(out, "POS", "REF_AD", "ALT_AD", "ID") == [
        (5, 12, 30, "chr1_5_A_G"), (6, 15, None, "chr1_6_A_G"), (7, None, 3, "chr1_7_A_G"), (8, None, None, "chr1_8_A_G")]


def test_merge_keeps_duplicates_and_orders_columns(spark):
    one = calls(spark, call())
    two = calls(spark, call(), call("S2")).select(*reversed(CALL_COLUMNS))
    assert K.merge_calls(one, two).count() == 3


def test_genotype_counts(spark):
    got = K.genotype_counts(calls(spark, call(), call(pos=7), call(gt="1/1", pos=8), call("S2")))
    assert records(got, "SampleID", "GT", "n_calls", "n_records") == [("S1", "0/1", 2, 3), ("S1", "1/1", 1, 3), ("S2", "0/1", 1, 1)]


def test_intersection_keeps_primary_fields(spark):
    primary = calls(spark, call(dp=1), call(pos=101), call("S2"))
    other = calls(spark, call(dp=99), call("S2", alt="T"), call(dp=5))
    assert records(K.intersect_callers(primary, other), "SampleID", "POS", "DP") == [("S1", 100, 1)]


def test_flatten_entries(spark):
    row = ((("chr1", 9)), ["A", "G"], [
        ("a", ([0, 1], True), [3, 4], 50), ("b", ([0, 0], False), [9, 0], 50), ("c", None, None, None),
        ("d", ([1, 1], False), None, 20), ("e", ([None, 1], False), [1, 1], 20), ("f", ([1, 0], False), [5], 7)])
    got = K.flatten_entries(spark.createDataFrame([row], ENTRIES))
    assert records(got, "SampleID", "CHROM", "POS", "REF", "ALT", "GT", "DP", "GQ", "REF_AD", "ALT_AD", "ID") == [
        ("a", "chr1", 9, "A", "G", "0/1", 7, 50, 3, 4, "chr1_9_A_G"),
        ("d", "chr1", 9, "A", "G", "1/1", None, 20, None, None, "chr1_9_A_G"),
        ("f", "chr1", 9, "A", "G", "1/0", 5, 7, 5, None, "chr1_9_A_G")]


def _lines(spark, *rows):
    return spark.createDataFrame([("\t".join(r),) if isinstance(r, tuple) else (r,) for r in rows], "value string")


def _line(chrom="chr1", pos="10", ref="A", alt="G,<NON_REF>", fmt="GT:AD:DP:GQ", sample="0/1:5,6,0:11:99"):
    return (chrom, pos, ".", ref, alt, ".", "PASS", ".", fmt, sample)


def test_gvcf_to_calls(spark):
    lines = _lines(
        spark, "##fileformat=VCFv4.2", "#CHROM\tPOS",
        _line(alt="<NON_REF>", sample="0/0:5,0:5:9"), _line(),
        _line(pos="11", alt="C,G,T", sample="2/3:1,2,9,8:20:40"),
        _line(pos="12", sample="0/0:5,6,0:11:99"), _line(pos="13", sample=".|.:5,6,0:11:99"),
        _line(pos="14", sample="0/1:5,6,0:.:99"), _line(pos="15", sample="0/1:.:11:99"), _line(pos="16", sample="0/1:5,6,0:11"),
        _line(pos="17", sample="./1:5,6,0:11:99"), _line(pos="18", fmt="GT:GQ:DP:AD", sample="1|1:30:12:0,12,0"),
        _line(pos="19", alt="*,<NON_REF>", sample="0/1:5,6,0:11:99"), _line(pos="20", ref="AT", alt="GC"),
        _line(chrom="chrM", pos="21"), _line(chrom="chr1_KI270706v1_random", pos="22"),
        _line(pos="23", ref="AT", alt="A,ATT,<NON_REF>", sample="1/2:1,2,3,0:6:60"))
    records_ = parse_gvcf(lines)
    got = records(S.extract_calls(records_), "POS", "REF", "ALT", "GT", "DP", "AD", "GQ")
    assert got == sorted([
        (10, "A", "G", "0/1", 11, "5,6", 99), (11, "A", "G", "1/0", 20, "1,9", 40), (11, "A", "T", "0/1", 20, "1,8", 40),
        (17, "A", "G", "./1", 11, "5,6", 99), (18, "A", "G", "1|1", 12, "0,12", 30),
        (23, "AT", "A", "1/0", 6, "1,2", 60), (23, "AT", "ATT", "0/1", 6, "1,3", 60)], key=lambda r: [str(v) for v in r])
    everywhere = S.extract_calls(records_, contigs=None)
    assert {r["CHROM"] for r in everywhere.collect()} == {"chr1", "chrM", "chr1_KI270706v1_random"}


def test_unique_variants_and_counts(spark):
    df = calls(spark, call(), call("S2"), call(chrom="chr10"), call(pos=5), call(chrom="chr2"))
    unique = S.unique_variants(df)
    assert records(unique, "ID") == [("chr10_100_A_G",), ("chr1_100_A_G",), ("chr1_5_A_G",), ("chr2_100_A_G",)]
    assert [tuple(r) for r in S.variants_per_chrom(unique).collect()] == [("chr1", 2), ("chr10", 1), ("chr2", 1), ("all", 4)]
    assert S.vcf_rows(df).count() == unique.count()
    row = S.vcf_rows(df).filter("POS = 5").head()
    assert tuple(row) == ("chr1", 5, "chr1_5_A_G", "A", "G", ".", "PASS", ".")


def test_sample_count(spark):
    assert K.sample_count(calls(spark, call(), call(pos=7), call("S2"))).head()[0] == 2
