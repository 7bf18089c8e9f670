"""Steps that a query needs more than once are worked out once and stored."""

import os
import re

import pytest
from helpers import call, calls, records, unfiltered
from __spark_entry__ import queries
from checks import proxy as P
from variantloom.operators import curate as C
from variantloom.operators import integrate as I

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["rare_small", "curation_funnel", "other_consequences", "curated_db", "cohort_funnel", "unfiltered_db"])
def test_order_lines_are_joined_once(spark, name):
    files = queries()[name](spark, SF).inputFiles()
    assert files and not [f for f in files if os.path.basename(f).startswith(("lineitem", "orders"))]


def test_lookup_reads_its_variants_from_a_table(spark):
    variants = P.versioned_transcripts(spark, SF)
    files = variants.inputFiles()
    assert files and not [f for f in files if os.path.basename(f).startswith(("lineitem", "orders"))]
    plain = P.vep(spark, SF).selectExpr(
        "ID", "split(ID, '_')[0] AS CHROM", "CAST(split(ID, '_')[1] AS INT) AS POS", "split(ID, '_')[2] AS REF",
        "split(ID, '_')[3] AS ALT", "concat(Feature, '.3') AS Feature")
    assert variants.columns == plain.columns and records(variants) == records(plain)


def test_funnel_aggregates_pairs_once(spark):
    plan = C.curation_funnel(unfiltered(spark, (call(), {})))._jdf.queryExecution().optimizedPlan().toString()
    assert "max(_rare_outside" not in plan


def test_funnels_count_samples_once(spark):
    for name in ("cohort_funnel", "curation_funnel"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "distinct SampleID" not in plan and "n_samples" in plan


def test_matrix_entries_are_made_after_the_shuffle(spark):
    wide, plain = P.wide_matrix(spark, SF), P.matrix(spark, SF)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_list" in plan

    def entries(df):
        return df.selectExpr("locus", "alleles", "inline(entries)").groupBy("locus", "alleles", "s", "GT", "AD", "GQ").count()

    assert wide.schema == plain.schema and records(entries(wide)) == records(entries(plain))


def test_call_shuffles_carry_neither_id_nor_hash(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (I.annotate_calls, I.annotated_calls):
            rows = join(P.calls(spark, SF), P.annotations(spark, SF).filter("Gene IS NOT NULL"))
            join_node = rows._jdf.queryExecution().optimizedPlan()
            while "Join" not in join_node.nodeName():
                join_node = join_node.children().head()
            carried = join_node.children().head().output().mkString(",")
            assert "CHROM#" in carried and "ID#" not in carried.replace("SampleID#", "") and "_fresh" not in carried
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_ids_that_coordinates_do_not_spell_are_joined_as_they_are(spark):
    rows = [call("S1"), call("S2")[:-1] + ("rs1",), call("S3")[:-1] + (None,), call("S4", ref=None)[:-1] + ("chr1_100_G",)]
    ids = ["chr1_100_A_G", "rs1", "chr1_100_G", None]
    known = spark.createDataFrame([("chr1", i, f"T{n}") for n, i in enumerate(ids)], "Chr string, ID string, Feature string")
    made = calls(spark, *rows)
    assert records(I.annotate_calls(made, known), "SampleID", "ID", "Feature") == [
        ("S1", "chr1_100_A_G", "T0"), ("S2", "rs1", "T1"), ("S4", "chr1_100_G", "T2")]
    semi = I.annotated_calls(made, known)
    assert semi.columns == made.columns and [r[0] for r in records(semi)] == ["S1", "S2", "S4"]


def test_carriers_are_joined_as_they_were_counted(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()["curated_large"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not re.search(r"Exchange hashpartitioning\(CHROM#\d+, POS#\d+, REF#\d+, ALT#\d+, \d+\)", plan)
    # carriers, the annotation rows they join and the distinct IDs of the sample counts
    assert len(re.findall(r"\bExchange hashpartitioning\(CHROM#\d+, ID#\d+, \d+\)", plan)) == 3


@pytest.mark.parametrize("name", ["other_consequences", "variant_type_counts_before", "variant_type_counts_after", "variant_type", "rare_small", "rare_large"])
def test_no_unfiltered_table_is_stored_on_the_way(spark, name):
    files = queries()[name](spark, SF).inputFiles()
    assert files and not [f for f in files if "/unfiltered-" in f]
