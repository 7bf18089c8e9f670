import pytest
from pyspark.sql import functions as F

from helpers import call, raw_annotation, records, unfiltered
from variantloom.operators import annotations as A
from variantloom.operators import curate as C
from variantloom.operators import integrate as I
from variantloom.plans import cohort
from variantloom.schemas import CURATED_COLUMNS, PLUGINS
from helpers import calls as call_table


@pytest.mark.parametrize("dp,gq,alt,kept", [
    (0, 50, 5, False), (None, 50, 5, False), (20, 30, 4, True), (20, 30, 16, True), (19, 30, 8, False), (20, 29, 8, False),
    (20, 30, 3, False), (20, 30, 17, False), (20, None, 8, False), (20, 30, None, False)])
def test_qc(spark, dp, gq, alt, kept):
    rows = C.qc_filter(unfiltered(spark, (call(dp=dp, gq=gq, alt_ad=alt), {}))).collect()
    assert len(rows) == kept
    if kept:
        assert rows[0]["AC_ratio"] == alt / dp


def _four_samples(spark, *extra):
    """Four samples on the chromosome; S1 carries chr1_100."""
    return unfiltered(spark, (call("S1"), {}), (call("S1", gt="1/1"), {"Feature": "T2"}), (call("S2", pos=7, dp=1), {}),
                      (call("S3", pos=8), {}), (call("S4", pos=9), {}), *extra)


def test_dataset_af_counts_carriers_once_over_chromosome_samples(spark):
    table = _four_samples(spark, (call("S9", chrom="chr2"), {}))
    qc = C.qc_filter(table)
    chromosome = C.variant_frequencies(qc, C.sample_counts(table))
    assert records(chromosome, "CHROM", "POS", "dataset_AF") == [
        ("chr1", 100, 1 / 8), ("chr1", 8, 1 / 8), ("chr1", 9, 1 / 8), ("chr2", 100, 1 / 2)]
    whole = C.variant_frequencies(qc, C.sample_counts(table, "cohort"))
    assert {r["dataset_AF"] for r in whole.collect()} == {1 / 10}
    listed = C.variant_frequencies(qc, C.sample_counts(table), contigs=["chr2"])
    assert records(listed, "CHROM", "dataset_AF") == [("chr2", 0.5)]


def test_cohort_denominator_ignores_the_contig_slice(spark):
    table = _four_samples(spark, (call("S9", chrom="chr2"), {}))
    sliced = C.curate(table, denominator="cohort", contigs=["chr2"])
    assert records(sliced, "CHROM", "dataset_AF") == [("chr2", 1 / 10)]


def test_rare_rule_switches_per_chromosome(spark):
    table = _four_samples(spark, (call("S9", chrom="chr2"), {}), (call("S4", pos=10), {"gnomAD_max_AF": 0.001}),
                          (call("S4", pos=11), {"gnomAD_max_AF": 0.0011}), (call("S4", pos=12), {"gnomAD_max_AF": None}))
    qc = C.qc_filter(table)
    rows = C.attach_frequencies(qc, C.variant_frequencies(qc, C.sample_counts(table)))
    assert {r["POS"] for r in C.rare_filter(rows).filter("CHROM = 'chr1'").collect()} == {100, 8, 9, 10}
    assert {r["CHROM"] for r in C.rare_filter(rows, min_samples=4).collect()} == {"chr2"}
    assert {r["CHROM"] for r in C.rare_filter(rows, max_af=0.125, min_samples=4).collect()} == {"chr1", "chr2"}


@pytest.mark.parametrize("fields,kept", [
    ({"Consequence": "stop_gained,x", "LoF": "HC"}, True), ({"Consequence": "stop_gained", "LoF": "LC"}, False),
    ({"Consequence": "frameshift_variant"}, False), ({"Consequence": "frameshift_variant", "LoF": "HC"}, True),
    ({"Consequence": "splice_donor_variant", "DS_AG": "0.8"}, True), ({"Consequence": "splice_donor_variant", "DS_DL": "0.79"}, False),
    ({"Consequence": "splice_donor_variant"}, False), ({"Consequence": "splice_donor_variant", "DS_AG": "bad", "DS_AL": "0.9"}, True),
    ({"Consequence": "missense_variant", "am_pathogenicity": 0.564}, True),
    ({"Consequence": "missense_variant", "am_pathogenicity": 0.5639}, False), ({"Consequence": "missense_variant"}, False),
    ({"Consequence": "synonymous_variant"}, True), ({"Consequence": "intron_variant", "LoF": "HC", "am_pathogenicity": 1.0}, False)])
def test_impact(spark, fields, kept):
    out = C.curate(unfiltered(spark, (call(), fields)))
    assert out.columns == CURATED_COLUMNS
    assert out.count() == kept


def _cohort(spark):
    """Calls and annotation tables with every class, an un-annotated variant and repeated calls."""
    consequences = ["synonymous_variant", "missense_variant", "stop_gained,x", "splice_donor_variant", "intron_variant"]
    rows, default, plugin = [], [], {p: [] for p in PLUGINS}
    for c in ("chr1", "chr2", "chrX"):
        for v in range(30):
            variant = call(chrom=c, pos=v)
            for s in range(12):
                if (s * 7 + v * 3) % 5 < 2:
                    rows.append(call(f"S{s}", c, v, dp=10 + 3 * s, gq=20 + v, alt_ad=8))
            if v % 4 == 0:
                rows.append(call("S1", c, v, dp=50, gq=90, alt_ad=25))
                rows.append(call("S1", c, v, dp=50, gq=90, alt_ad=25))
            if v % 6 == 5:
                continue
            for k in range(2):
                key = dict(Uploaded_variation=variant[-1], Location=f"{c}:{v}", Allele="G", Gene="G", Feature=f"T{c}{v}{k}", Chr=c)
                default.append({**key, "Consequence": consequences[(v + k) % 5], "CANONICAL": "YES", "gnomADe_AF": str(v / 20000)})
                plugin["loftee"].append({**key, "LoF": "HC" if v % 3 else "LC"})
                plugin["alphamissense"].append({**key, "am_pathogenicity": v / 30})
                plugin["spliceai"].append({**key, "SpliceAI_pred": f"S|0.{v % 10}|0|0|0|1|2|3|4"})
    tables = {"default": A.reshape_annotation(raw_annotation(spark, "default", *default), "default")}
    tables.update({p: A.reshape_annotation(raw_annotation(spark, p, *plugin[p]), p) for p in PLUGINS})
    return call_table(spark, *rows), tables


@pytest.mark.parametrize("options", [{}, {"min_samples": 5, "max_af": 0.2}, {"denominator": "cohort"},
                                     {"contigs": ["chr1", "chrX"], "min_dp": 30},
                                     {"denominator": "cohort", "contigs": ["chr1"]}])
def test_fused_plans_equal_stored_ones(spark, options):
    calls, tables = _cohort(spark)
    annotations = I.integrate(tables["default"], [tables[p] for p in PLUGINS])
    stored = cohort.unfiltered(calls, tables).cache()
    curated = C.curate(stored, **options)
    assert records(cohort.curated_cohort(calls, annotations, **options)) == records(curated)
    assert curated.count() > 0
    funnel = records(C.curation_funnel(stored, **options))
    assert records(cohort.cohort_funnel(calls, annotations, **options)) == funnel


def _odd_cohort(spark):
    """The cohort with a call without REF, which an annotation names all the same, and calls of no sample."""
    calls, tables = _cohort(spark)
    notes = I.integrate(tables["default"], [tables[p] for p in PLUGINS])
    odd = [call("S1", pos=3, ref=None)[:-1] + ("chr1_3_G",), call("S7", pos=4), call(None, pos=4), call(None, pos=4)]
    known = notes.filter("ID = 'chr1_3_A_G'").withColumn("ID", F.lit("chr1_3_G"))
    return calls.unionByName(call_table(spark, *odd)), notes.unionByName(known)


OPTIONS = [{}, {"min_samples": 5, "max_af": 0.2}, {"denominator": "cohort"}, {"contigs": ["chr1", "chrX"], "min_dp": 30}]


@pytest.mark.parametrize("options", OPTIONS)
def test_other_consequences_from_calls_equal_those_of_the_table(spark, options):
    calls, annotations = _odd_cohort(spark)
    expected = records(C.other_consequences(I.annotate_calls(calls, annotations), **options))
    assert records(cohort.cohort_other_consequences(calls, annotations, **options)) == expected != []


@pytest.mark.parametrize("options", OPTIONS)
def test_type_counts_from_calls_equal_those_of_the_table(spark, options):
    calls, annotations = _odd_cohort(spark)
    table = I.annotate_calls(calls, annotations).cache()
    for damaging in (False, True):
        expected = records(C.variant_type_counts(table, damaging_only=damaging, **options))
        assert records(cohort.cohort_type_counts(calls, annotations, damaging_only=damaging, **options)) == expected != []


@pytest.mark.parametrize("options", [{}, {"min_samples": 5, "max_af": 0.2}, {"denominator": "cohort"}])
def test_rare_rows_from_calls_equal_those_of_the_table(spark, options):
    calls, annotations = _odd_cohort(spark)
    counts = {k: v for k, v in options.items() if k == "denominator"}
    table = I.annotate_calls(calls, annotations).cache()
    rows = C.attach_frequencies(C.qc_filter(table), C.cohort_frequencies(table, **counts))
    rare = C.classify(C.rare_filter(rows, **{k: v for k, v in options.items() if k != "denominator"}))
    expected = records(rare, *sorted(rare.columns))
    assert records(cohort.rare_cohort(calls, annotations, **options), *sorted(rare.columns)) == expected != []


def test_funnel_is_monotone_and_agrees_with_tables(spark):
    calls, tables = _cohort(spark)
    stored = cohort.unfiltered(calls, tables).cache()
    funnel = C.curation_funnel(stored).collect()
    pairs = {(r["CHROM"], r["step"]): r["value"] for r in funnel if r["metric"] == "pairs"}
    for c in ("chr1", "chr2", "chrX"):
        assert pairs[c, 1] >= pairs[c, 2] >= pairs[c, 3] > 0
    after = sum(r["value"] for r in funnel if r["step"] == 5)
    curated = C.curate(stored)
    assert after == curated.count() == sum(r["n"] for r in C.variant_type_counts(stored, damaging_only=True).collect())
    keys = ["SampleID", "CHROM", "POS", "REF", "ALT", "Feature"]
    assert curated.join(stored, keys, "left_anti").count() == 0
    before = {(r["CHROM"], r["Variant_Type"]): r["n"] for r in C.variant_type_counts(stored).collect()}
    assert before == {(r["CHROM"], r["metric"]): r["value"] for r in funnel if r["step"] == 4}
    other = C.other_consequences(stored).collect()
    assert sum(r["n"] for r in other) == sum(n for (c, t), n in before.items() if t == "Other")
    assert {r["stage"] for r in funnel if r["step"] == 3} == {"rare: gnomAD_max_AF"}
    strict = C.curation_funnel(stored, min_samples=5, max_af=0.2).collect()
    assert {r["stage"] for r in strict if r["step"] == 3} == {"rare: gnomAD_max_AF and dataset_AF"}


def test_cohort_counts(spark):
    got = C.cohort_counts(_four_samples(spark, (call("S9", chrom="chr2"), {})))
    assert records(got, "CHROM", "metric", "value") == [
        ("chr1", "pairs", 4), ("chr1", "samples", 4), ("chr1", "variants", 4),
        ("chr2", "pairs", 1), ("chr2", "samples", 1), ("chr2", "variants", 1)]


def test_chromosome_with_nothing_left_keeps_its_counts(spark):
    got = C.curation_funnel(unfiltered(spark, (call(dp=1), {})))
    assert records(got, "step", "metric", "value") == [
        (1, "pairs", 1), (1, "samples", 1), (1, "variants", 1), (2, "pairs", 0), (3, "pairs", 0)]


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


@pytest.fixture
def low_skew_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(spark, n):
    """Two thirds of the calls are one variant."""
    rows = spark.range(n).select(
        F.concat(F.lit("S"), "id").alias("SampleID"), F.lit("chr1").alias("CHROM"),
        F.when(F.col("id") % 3 > 0, 100).otherwise(F.col("id") + 1000).cast("int").alias("POS"), F.lit("A").alias("REF"),
        F.lit("G").alias("ALT"), F.lit("0/1").alias("GT"), F.lit(40).alias("DP"), F.lit(50).alias("GQ"),
        F.lit(20).alias("REF_AD"), F.lit(20).alias("ALT_AD"))
    return rows.withColumn("ID", F.concat_ws("_", "CHROM", F.col("POS").cast("string"), "REF", "ALT"))


def _notes(hot):
    """One synonymous annotation per variant, grouped by the join key already."""
    text = {"Location": "L", "Allele": "G", "Gene": "G", "Feature": "T", "Consequence": "synonymous_variant",
            "CANONICAL": "YES", "MANE": None, "MAX_AF_POPS": None, "LoF": None,
            **{d: None for d in ("DS_AG", "DS_AL", "DS_DG", "DS_DL")}}
    return hot.select("CHROM", "ID").distinct().select(
        "ID", F.col("CHROM").alias("Chr"), F.col("ID").alias("ID_variant_gene"),
        *[F.lit(v).cast("string").alias(k) for k, v in text.items()],
        *[F.lit(0.0).alias(c) for c in ("MAX_AF", "gnomAD_max_AF", "am_pathogenicity")])


@pytest.mark.parametrize("plan", ["annotate", "semi", "frequencies", "curate", "fused"])
def test_hot_variant_is_split(spark, low_skew_limits, plan):
    """Adaptive execution cuts the hot variant's partition, and every row comes out."""
    n = 60_000
    hot = _hot(spark, n)
    notes = _notes(hot)
    qc = C.qc_filter(hot)
    df = {
        "annotate": lambda: I.annotate_calls(hot, notes),
        "semi": lambda: I.annotated_calls(hot, notes),
        "frequencies": lambda: C.attach_frequencies(qc, C.variant_frequencies(qc, C.sample_counts(hot), ["chr1"])),
        "curate": lambda: C.curate(I.annotate_calls(hot, notes), min_samples=n + 1, contigs=["chr1"]),
        "fused": lambda: cohort.curated_cohort(hot, notes, min_samples=n + 1, contigs=["chr1"]),
    }[plan]()
    rows = df.collect()
    assert len(rows) == n
    if "dataset_AF" in df.columns:
        assert {r["dataset_AF"] for r in rows if r["POS"] == 100} == {(n * 2 // 3) / (2 * n)}
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
