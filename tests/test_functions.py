import random

import pytest
from pyspark.sql import functions as F

from helpers import records
from variantloom.functions import text, variant


def test_common_prefix_and_suffix_match_brute_force(spark):
    rng = random.Random(1)
    pairs = [("", ""), ("A", ""), ("ACG", "ACG"), ("ACG", "ACGT"), ("A" * 700, "A" * 699 + "C")]
    pairs += [("".join(rng.choice("AC") for _ in range(rng.randint(0, 40))),
               "".join(rng.choice("AC") for _ in range(rng.randint(0, 40)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", text.common_prefix_length(F.col("a"), F.col("b")).alias("p"),
        text.common_suffix_length(F.col("a"), F.col("b")).alias("s"))

    def prefix(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for a, b, p, s in df.collect():
        assert p == prefix(a, b)
        assert s == prefix(a[::-1], b[::-1])


def _class(ref, alt):
    """Plain restatement: strip the shared prefix, then the shared suffix."""
    r, a = ref.upper(), alt.upper()
    if not r.isalpha() or not a.isalpha() or r == a or (len(r) == 1 and a == "X"):
        return "other"
    while r and a and r[0] == a[0]:
        r, a = r[1:], a[1:]
    while r and a and r[-1] == a[-1]:
        r, a = r[:-1], a[:-1]
    if not r or not a:
        return "indel"
    return "snv" if len(r) == len(a) == 1 else "other"


def test_allele_class(spark):
    rng = random.Random(2)
    pairs = [("A", "G"), ("a", "A"), ("A", "AT"), ("AT", "A"), ("AT", "GC"), ("AT", "GT"), ("A", "<NON_REF>"), ("A", "*"),
             ("A", "."), ("A", "]chr2:5]A"), ("ATG", "CC"), ("GATC", "GC"), ("A", "X"), ("N", "A"), ("AAA", "AA")]
    pairs += [("".join(rng.choice("ACG") for _ in range(rng.randint(1, 6))),
               "".join(rng.choice("ACG") for _ in range(rng.randint(1, 6)))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "r string, a string")
    for r, a, got in df.select("r", "a", variant.allele_class(F.col("r"), F.col("a"))).collect():
        assert got == _class(r, a), (r, a)


@pytest.mark.parametrize("gt,number,expected", [
    ("2/3", 1, "0/0"), ("2/3", 2, "1/0"), ("2/3", 3, "0/1"), ("0|2", 2, "0|1"), ("./1", 1, "./1"), ("1", 1, "1"),
    ("0/1/2", 2, "0/0/1"), ("10/2", 10, "1/0"), ("0/1|2", 1, "0/1|0"),
])
def test_genotype_for_allele(spark, gt, number, expected):
    df = spark.createDataFrame([(gt, number)], "gt string, n int")
    assert df.select(variant.genotype_for_allele(F.col("gt"), F.col("n"))).head()[0] == expected


def test_format_field_by_name_and_missing(spark):
    df = spark.createDataFrame([("GT:AD:DP", "0/1:1,2:3"), ("DP:GT", "7"), ("AD", "1")], "f string, s string")
    got = df.select(*[text.format_field("f", "s", k) for k in ("GT", "DP")]).collect()
    assert [tuple(r) for r in got] == [("0/1", "3"), (None, "7"), (None, None)]


@pytest.mark.parametrize("consequence,expected", [
    ("synonymous_variant", "Synonymous"), ("synonymous_variant,x", "Other"),
    ("splice_region_variant,synonymous_variant", "Other"), ("stop_gained,splice_region_variant", "Stop_Gained"),
    ("frameshift_variant", "Frameshift"), ("splice_acceptor_variant", "Splice_variants"),
    ("splice_donor_variant,intron_variant", "Splice_variants"), ("missense_variant", "Missense"), (None, "Other"),
])
def test_variant_type(spark, consequence, expected):
    df = spark.createDataFrame([(consequence,)], "Consequence string")
    assert df.select(variant.variant_type()).head()[0] == expected


def test_keys_skip_nulls(spark):
    df = spark.createDataFrame([("chr1:5", None, None, "T1")], "Location string, Allele string, Gene string, Feature string")
    assert df.select(variant.annotation_key()).head()[0] == "chr1:5:T1"
