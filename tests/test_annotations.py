from helpers import call, calls, raw_annotation, records
from variantloom.operators import annotations as A
from variantloom.operators import integrate as I

KEY = dict(Location="chr1:100", Allele="G", Gene="G1", Feature="T1", Uploaded_variation="chr1_100_A_G")


def _table(spark, plugin, *rows):
    return A.reshape_annotation(raw_annotation(spark, plugin, *rows), plugin)


def test_default_frequencies(spark):
    got = _table(spark, "default",
                 {**KEY, "Feature": "a"},
                 {**KEY, "Feature": "b", "gnomADe_AF": "0.0003", "gnomADg_SAS_AF": "0.0009", "MAX_AF": 0.2},
                 {**KEY, "Feature": "c", "gnomADe_AF": "bad", "gnomADg_AF": "0.5"})
    assert records(got, "Feature", "gnomAD_max_AF", "MAX_AF", "ID") == [
        ("a", 0.0, 0.0, "chr1_100_A_G"), ("b", 0.0009, 0.2, "chr1_100_A_G"), ("c", 0.5, 0.0, "chr1_100_A_G")]
    assert "gnomADe_AF" not in got.columns


def test_spliceai_parts(spark):
    got = _table(spark, "spliceai", {**KEY, "SpliceAI_pred": "SYM|0.1|0.2|0.3|0.4|-1|2|3|4"}, {**KEY, "Feature": "T2"},
                 {**KEY, "Feature": "T3", "SpliceAI_pred": "SYM|0.1"})
    assert records(got, "Feature", "SYMBOL", "DS_AG", "DS_DL", "DP_AG", "DP_DL") == [
        ("T1", "SYM", "0.1", "0.4", "-1", "4"), ("T3", "SYM", "0.1", None, None, None)]


def test_plugins_drop_empty_rows(spark):
    am = _table(spark, "alphamissense", KEY, {**KEY, "Feature": "T2", "am_class": "x"}, {**KEY, "Feature": "T3", "am_pathogenicity": 0.5})
    assert records(am, "Feature") == [("T2",), ("T3",)]
    lof = _table(spark, "loftee", KEY, {**KEY, "Feature": "T2", "LoF_info": "i"})
    assert records(lof, "Feature", "ID_variant_gene") == [("T2", "chr1:100:G:G1:T2")]


def _default(spark, *rows):
    return _table(spark, "default", *[{"CANONICAL": "YES", **r} for r in rows])


def test_integrate_left_joins_and_keeps_primary(spark):
    default = _default(spark, KEY, {**KEY, "Feature": "T2", "CANONICAL": None}, {**KEY, "Feature": "T3", "CANONICAL": None, "MANE": "NM"},
                       {**KEY, "Allele": None, "Gene": None, "Feature": "T4"})
    lof = _table(spark, "loftee", {**KEY, "LoF": "HC"}, {**KEY, "Allele": None, "Gene": None, "Feature": "T4", "LoF": "LC"},
                 {**KEY, "Feature": "T2", "LoF": "HC"})
    assert records(I.integrate(default, [lof]), "Feature", "LoF") == [("T1", "HC"), ("T3", None), ("T4", "LC")]


def test_integrate_text_key_fans_out_unless_strict(spark):
    other = {**KEY, "Uploaded_variation": "chr1_99_AA_AG"}
    default = _default(spark, KEY, other)
    lof = _table(spark, "loftee", {**KEY, "LoF": "HC"}, {**other, "LoF": "LC"})
    assert I.integrate(default, [lof]).count() == 4
    assert records(I.integrate(default, [lof], strict_key=True), "ID", "LoF") == [("chr1_100_A_G", "HC"), ("chr1_99_AA_AG", "LC")]


def test_annotate_calls_and_coverage(spark):
    annotations = I.integrate(_default(spark, KEY, {**KEY, "Feature": "T2"}, {**KEY, "Uploaded_variation": "chr1_7_A_G"},
                                       {**KEY, "Uploaded_variation": "chr9_7_A_G", "Chr": "chr9"}), [])
    df = calls(spark, call(), call("S2"), call(pos=101), call(chrom="chr2"))
    out = I.annotate_calls(df, annotations)
    assert records(out, "SampleID", "Feature") == [("S1", "T1"), ("S1", "T2"), ("S2", "T1"), ("S2", "T2")]
    assert out.columns[:3] == ["ID", "SampleID", "CHROM"] and "Location" not in out.columns
    assert records(I.annotated_calls(df, annotations), "SampleID") == [("S1",), ("S2",)]
    assert records(I.id_coverage(df, annotations), "CHROM", "shared", "calls_only", "annotation_only") == [
        ("chr1", 1, 1, 1), ("chr2", 0, 1, 0)]


def test_score_lookup_exact_alleles_and_transcript(spark):
    variants = spark.createDataFrame([("chr1", 5, "A", "G", "T1"), ("chr1", 5, "A", "T", "T1")],
                                     "CHROM string, POS int, REF string, ALT string, Feature string")
    scores = spark.createDataFrame([("chr1", 5, "A", "G", "T1", 0.9), ("chr1", 5, "A", "G", "T2", 0.1)],
                                   "CHROM string, POS int, REF string, ALT string, Feature string, s double")
    assert records(A.score_lookup(variants, scores, match_feature=True), "ALT", "s") == [("G", 0.9), ("T", None)]
    assert A.score_lookup(variants, scores.drop("Feature")).count() == 3
