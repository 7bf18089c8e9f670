"""Calls, annotations, call files and reference sequence derived from the given tables.

The tables hold no genomic data. Every view here is a deterministic projection or join of them, so
the work of a query grows with the tables. The SQL text of the same views is in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.schemas import ANNOTATION_KEYS, PLUGINS, annotation_columns
from variantloom.operators.annotations import reshape_annotation
from variantloom.operators.integrate import integrate
from variantloom.session import stored
from variantloom.sinks.text import write_gathered_gvcfs

CHROM = "CASE WHEN {k} % 24 = 22 THEN 'chrX' WHEN {k} % 24 = 23 THEN 'chrY' ELSE concat('chr', CAST({k} % 24 + 1 AS STRING)) END"
REF = "substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1)"
ALT = ("CASE WHEN l_suppkey % 5 = 0 THEN concat(substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1), 'AG') "
       "ELSE substr('ACGT', CAST((l_partkey + 1 + l_suppkey % 3) % 4 AS INT) + 1, 1) END")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark, sf_dir):
    """Order lines with their customer, from which calls are made."""
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")
    ).selectExpr("l_partkey", "l_suppkey", "l_linenumber", "o_custkey", "CAST(l_quantity AS INT) + 10 AS d0",
                 "d0 * CAST(round(l_discount * 100) AS INT) AS a0")


def calls(spark, sf_dir, helper=False, lines=None):
    """Calls from order lines: sample = customer, variant = part and supplier. ``helper`` keeps ``pk``."""
    out = (order_lines(spark, sf_dir) if lines is None else lines).selectExpr(
        "concat('S', CAST(o_custkey AS STRING)) AS SampleID",
        CHROM.format(k="l_partkey") + " AS CHROM",
        "CAST(1000 + l_partkey * 10 AS INT) AS POS",
        REF + " AS REF", ALT + " AS ALT",
        "CASE l_linenumber % 3 WHEN 0 THEN '0/1' WHEN 1 THEN '1/0' ELSE '1/1' END AS GT",
        "CASE WHEN d0 = 11 THEN NULL WHEN d0 = 12 THEN 0 ELSE d0 END AS DP",
        "CAST(10 + 10 * l_linenumber AS INT) AS GQ",
        "d0 - CAST((a0 - a0 % 10) / 10 AS INT) AS REF_AD",
        "CAST((a0 - a0 % 10) / 10 AS INT) AS ALT_AD",
        f"concat_ws('_', {CHROM.format(k='l_partkey')}, CAST(1000 + l_partkey * 10 AS STRING), {REF}, {ALT}) AS ID",
        "l_partkey AS pk", "l_suppkey AS sk", "l_linenumber AS ln",
    )
    return out if helper else out.drop("pk", "sk", "ln")


def raw_calls(spark, sf_dir):
    """Call file rows: allele depths still joined, some without a comma."""
    return calls(spark, sf_dir).select(
        "SampleID", "CHROM", "POS", "REF", "ALT", "GT", "DP", "GQ",
        F.expr("CASE WHEN POS % 70 = 0 THEN CAST(REF_AD AS STRING) "
               "ELSE concat(CAST(REF_AD AS STRING), ',', CAST(ALT_AD AS STRING)) END").alias("AD"))


def annotated_variants(spark, sf_dir, lines=None):
    """``pk, ALT`` of the annotated variants: all their other columns follow from these."""
    lines = order_lines(spark, sf_dir) if lines is None else lines
    return lines.filter("l_partkey % 13 <> 0").selectExpr("l_partkey AS pk", ALT + " AS ALT").distinct()


def vep(spark, sf_dir, variants=None):
    """Annotator rows, three transcripts per annotated variant, all payloads side by side."""
    chrom, ref = CHROM.format(k="pk"), REF.replace("l_partkey", "pk")
    variants = (annotated_variants(spark, sf_dir) if variants is None else variants).selectExpr(
        f"concat_ws('_', {chrom}, CAST(1000 + pk * 10 AS STRING), {ref}, ALT) AS ID", chrom + " AS CHROM",
        "CAST(1000 + pk * 10 AS INT) AS POS", ref + " AS REF", "ALT", "pk", "explode(sequence(1, 3)) AS k")
    return variants.selectExpr(
        "ID", "concat(CHROM, ':', CAST(POS AS STRING)) AS Location",
        "CASE WHEN length(ALT) > 1 THEN substr(ALT, 2) ELSE ALT END AS Allele",
        "CASE WHEN pk % 11 = 0 AND k = 3 THEN NULL ELSE concat('ENSG', CAST(pk % 500 AS STRING)) END AS Gene",
        "concat('ENST', CAST(pk AS STRING), '.', CAST(k AS STRING)) AS Feature",
        "CASE (pk + k) % 8 WHEN 0 THEN 'synonymous_variant' WHEN 1 THEN 'missense_variant' "
        "WHEN 2 THEN 'stop_gained,splice_region_variant' WHEN 3 THEN 'frameshift_variant' "
        "WHEN 4 THEN 'splice_acceptor_variant' WHEN 5 THEN 'splice_donor_variant,intron_variant' "
        "WHEN 6 THEN 'splice_region_variant,synonymous_variant' ELSE 'intron_variant' END AS Consequence",
        "CASE WHEN k = 1 THEN 'YES' END AS CANONICAL",
        "CASE WHEN k = 2 AND pk % 7 = 0 THEN 'NM_1.1' END AS MANE",
        "CASE WHEN pk % 9 = 0 THEN NULL ELSE CAST(pk % 50 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS MAX_AF",
        "CASE WHEN pk % 9 = 0 THEN NULL ELSE 'gnomADe_AFR' END AS MAX_AF_POPS",
        "CASE WHEN pk % 5 = 0 THEN NULL ELSE CAST(pk % 40 AS DOUBLE) / CAST(20000 AS DOUBLE) END AS gnomADe_AF",
        "CASE WHEN pk % 3 = 0 THEN NULL ELSE CAST(pk % 30 AS DOUBLE) / CAST(20000 AS DOUBLE) END AS gnomADg_AF",
        "CASE WHEN pk % 4 = 3 THEN NULL ELSE concat('SYM', CAST(pk % 100 AS STRING), '|0.', CAST(pk % 10 AS STRING), "
        "'|0.00|0.', CAST(pk % 7 AS STRING), '|0.10|', CAST(pk % 50 AS STRING), '|-2|3|4') END AS SpliceAI_pred",
        "CASE WHEN (pk + k) % 8 = 1 THEN CASE WHEN pk % 3 = 0 THEN 'likely_pathogenic' ELSE 'ambiguous' END END AS am_class",
        "CASE WHEN (pk + k) % 8 = 1 THEN CAST(pk % 100 AS DOUBLE) / CAST(100 AS DOUBLE) END AS am_pathogenicity",
        "CASE WHEN (pk + k) % 8 IN (2, 3) THEN CASE WHEN pk % 3 = 0 THEN 'LC' ELSE 'HC' END END AS LoF",
        "CHROM AS Chr",
    )


def calls_and_annotations(spark, sf_dir):
    """Both from order lines that are joined once."""
    lines = stored(order_lines(spark, sf_dir), "lines")
    return calls(spark, sf_dir, lines=lines), annotations(spark, sf_dir, lines)


def annotator_rows(spark, sf_dir, plugin, base=None):
    """Raw rows of one plugin's tab file; the frequency columns the view lacks are missing throughout."""
    base = base or vep(spark, sf_dir)

    def column(name):
        if name == ANNOTATION_KEYS[0]:
            return F.col("ID").alias(name)
        return F.col(name) if name in base.columns else F.lit(None).cast("string").alias(name)

    return base.select(*[column(c) for c in annotation_columns(plugin)], "Chr")


def annotation_tables(spark, sf_dir, lines=None):
    """All plugins' tables, from variants made distinct once."""
    base = vep(spark, sf_dir, stored(annotated_variants(spark, sf_dir, lines), "variants"))
    return {p: reshape_annotation(annotator_rows(spark, sf_dir, p, base), p) for p in ["default", *PLUGINS]}


def annotations(spark, sf_dir, lines=None):
    tables = annotation_tables(spark, sf_dir, lines)
    return integrate(tables["default"], [tables[p] for p in PLUGINS])


# Fields of the gVCF stand-in, each may use the ones before it; the SQL counterpart uses the same text.
GVCF_FIELDS = {
    "f_contig": "CASE WHEN pk % 29 = 0 THEN 'chrM' WHEN pk % 31 = 0 THEN 'chr1_KI270706v1_random' ELSE CHROM END",
    "f_ref": "CASE WHEN sk % 7 = 0 THEN concat(REF, 'T') ELSE REF END",
    "f_alt": "CASE WHEN sk % 7 = 0 AND pk % 2 = 0 THEN concat(substr('CGTA', CAST(pk % 4 AS INT) + 1, 1), 'T') "
             "WHEN sk % 7 = 0 THEN concat(substr('CGTA', CAST(pk % 4 AS INT) + 1, 1), 'C') ELSE ALT END",
    "f_alts": "CASE WHEN pk % 5 = 0 AND ln = 1 THEN '<NON_REF>' WHEN pk % 5 = 1 THEN concat(f_alt, ',*,<NON_REF>') "
              "WHEN pk % 5 = 2 THEN concat(f_alt, ',', f_ref, 'CC,<NON_REF>') ELSE concat(f_alt, ',<NON_REF>') END",
    "f_gt": "CASE WHEN pk % 5 IN (1, 2) AND ln % 4 = 0 THEN '1/2' WHEN pk % 5 IN (1, 2) AND ln % 4 = 1 THEN '2|1' "
            "WHEN ln % 7 = 2 THEN '0/0' WHEN ln % 7 = 3 THEN './.' WHEN ln % 7 = 4 THEN './1' ELSE GT END",
    "f_dp": "CASE WHEN DP IS NULL THEN '.' ELSE CAST(DP AS STRING) END",
    "f_ad": "CASE WHEN sk % 17 = 0 THEN '.' WHEN pk % 5 IN (1, 2) "
            "THEN concat(CAST(REF_AD AS STRING), ',', CAST(ALT_AD AS STRING), ',', CAST(ln AS STRING), ',0') "
            "ELSE concat(CAST(REF_AD AS STRING), ',', CAST(ALT_AD AS STRING), ',0') END",
}


def gvcf_fields(spark, sf_dir):
    # a select may use the aliases before it
    return calls(spark, sf_dir, helper=True).selectExpr("*", *[f"{text} AS {name}" for name, text in GVCF_FIELDS.items()])


def gvcf_lines(spark, sf_dir):
    """gVCF text with the sample beside it; FORMAT order varies and GQ is sometimes cut off.

    A line leaves as the output of a generator, so the parser's filters work on finished text as they
    do over a file, instead of being rewritten in terms of the pieces the line is made of.
    """
    fields = gvcf_fields(spark, sf_dir)
    layout = F.expr(
        "CASE WHEN pk % 3 = 0 THEN concat_ws('\t', 'GT:GQ:DP:AD', concat_ws(':', f_gt, CAST(GQ AS STRING), f_dp, f_ad)) "
        "WHEN sk % 19 = 0 THEN concat_ws('\t', 'GT:DP:AD:GQ', concat_ws(':', f_gt, f_dp, f_ad)) "
        "ELSE concat_ws('\t', 'GT:AD:DP:GQ', concat_ws(':', f_gt, f_ad, f_dp, CAST(GQ AS STRING))) END")
    line = F.concat_ws("\t", "f_contig", F.col("POS").cast("string"), F.lit("."), "f_ref", "f_alts", F.lit("."),
                       F.lit("PASS"), F.lit("."), layout)
    return fields.select("SampleID", F.explode(F.array(line)).alias("value"))


def write_annotator_files(spark, sf_dir, plugin, path):
    """Tab files with a header each; half of the transcripts in files whose columns stand in the opposite order."""
    rows = annotator_rows(spark, sf_dir, plugin).drop("Chr")
    straight = F.col("Feature").endswith(".1")
    for folder, part, columns in (("a", rows.filter(straight), rows.columns), ("b", rows.filter(~straight), rows.columns[::-1])):
        named = part.select(*columns).withColumnRenamed(columns[0], "#" + columns[0])
        named.write.options(sep="\t", header=True, nullValue="-", compression="gzip", extension="tsv", comment="~").csv(f"{path}/{folder}")


def write_gvcfs(spark, sf_dir, path):
    """One gVCF for each sample, gathered in files of bounded number; returns the manifest that lists the gVCFs."""
    gvcf = "concat('/data/gvcf/', {sample}, '.gvcf.gz')"
    write_gathered_gvcfs(gvcf_lines(spark, sf_dir).selectExpr(gvcf.format(sample="SampleID") + " AS path", "value"), path)
    samples = table(spark, sf_dir, "orders").selectExpr("concat('S', CAST(o_custkey AS STRING)) AS sampleID").distinct()
    return samples.selectExpr("sampleID", gvcf.format(sample="sampleID") + " AS Path")


def manifest(spark, sf_dir):
    """Two call files per customer, one per caller."""
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_mktsegment", F.posexplode(F.array(F.lit("gatk"), F.lit("deepvariant"))).alias("at", "caller"))
        .select(F.expr("concat('S', CAST(c_custkey AS STRING))").alias("sampleID"),
                F.expr("concat('/data/', c_mktsegment, '/', caller, '/S', CAST(c_custkey AS STRING), '.', caller, '.gvcf.gz')")
                .alias("Path"),
                F.expr("c_custkey * 2 + at").alias("line"))
    )


def staged_files(spark, sf_dir):
    """Base names of the files of customers with a finished order; gatk files only for even keys."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.expr("concat('S', CAST(o_custkey AS STRING), "
               "CASE WHEN o_custkey % 2 = 0 THEN '.gatk.gvcf.gz' ELSE '.deepvariant.gvcf.gz' END)").alias("file"))


# A call beside a hom-ref, a missing and a second carried entry, from the call's columns.
ENTRIES = """array(
  named_struct('s', concat({c}SampleID, 'r'), 'GT', named_struct('alleles', array(0, 0), 'phased', false), 'AD', array(30, 0), 'GQ', {c}GQ),
  named_struct('s', {c}SampleID, 'GT', named_struct('alleles', CASE {c}GT WHEN '0/1' THEN array(0, 1) WHEN '1/0' THEN array(1, 0) ELSE array(1, 1) END, 'phased', POS % 3 = 0), 'AD', array({c}REF_AD, {c}ALT_AD), 'GQ', {c}GQ),
  named_struct('s', concat({c}SampleID, 'm'), 'GT', CAST(NULL AS STRUCT<alleles: ARRAY<INT>, phased: BOOLEAN>), 'AD', CAST(NULL AS ARRAY<INT>), 'GQ', CAST(NULL AS INT)),
  named_struct('s', concat({c}SampleID, 'h'), 'GT', named_struct('alleles', array(1, 1), 'phased', false), 'AD', CAST(NULL AS ARRAY<INT>), 'GQ', 99))"""


def _matrix_rows(rows, entries):
    return rows.select(F.struct(F.col("CHROM").alias("contig"), F.col("POS").alias("position")).alias("locus"),
                       F.array("REF", "ALT").alias("alleles"), F.expr(entries).alias("entries"))


def matrix(spark, sf_dir):
    """Matrix rows: each call beside a hom-ref, a missing and a second carried entry."""
    return _matrix_rows(calls(spark, sf_dir), ENTRIES.format(c=""))


def wide_matrix(spark, sf_dir):
    """As :func:`matrix`, one row for each variant with the entries of all its samples, made after its calls are together."""
    call = F.struct("SampleID", "GT", "REF_AD", "ALT_AD", "GQ")
    together = calls(spark, sf_dir).groupBy("CHROM", "POS", "REF", "ALT").agg(F.collect_list(call).alias("of"))
    return _matrix_rows(together, "flatten(transform(of, c -> " + ENTRIES.format(c="c.") + "))")


def scores(spark, sf_dir):
    """Genome-wide score rows: every base change at the position of every part."""
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", F.explode(F.array(*[F.lit(b) for b in "ACGT"])).alias("ALT"))
        .selectExpr(CHROM.format(k="p_partkey") + " AS CHROM", "CAST(1000 + p_partkey * 10 AS INT) AS POS",
                    "substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) AS REF", "ALT",
                    "CAST(p_partkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS am_pathogenicity",
                    "CASE WHEN p_partkey % 3 = 0 THEN 'likely_pathogenic' ELSE 'ambiguous' END AS am_class")
        .filter("REF <> ALT")
    )


def transcript_scores(spark, sf_dir):
    """As :func:`scores`, one row for each of the first two transcripts, whose names have other versions than the annotator's."""
    return scores(spark, sf_dir).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({
        "Feature": F.expr("concat('ENST', CAST((POS - 1000) / 10 AS INT), '.', CAST(k AS STRING), '.', CAST(k + 6 AS STRING))"),
        "am_pathogenicity": F.expr("am_pathogenicity / CAST(k AS DOUBLE)")}).drop("k")


def versioned_transcripts(spark, sf_dir):
    """Variants with the transcripts the annotator names, with another version at the end; a lookup passes over them twice."""
    variants = stored(annotated_variants(spark, sf_dir), "variants").selectExpr(
        CHROM.format(k="pk") + " AS CHROM", "CAST(1000 + pk * 10 AS INT) AS POS", REF.replace("l_partkey", "pk") + " AS REF", "ALT", "pk")
    return variants.selectExpr("concat_ws('_', CHROM, CAST(POS AS STRING), REF, ALT) AS ID", "CHROM", "POS", "REF", "ALT",
                               "explode(array('.1.3', '.2.3', '.3.3')) AS v", "pk").selectExpr(
        "ID", "CHROM", "POS", "REF", "ALT", "concat('ENST', CAST(pk AS STRING), v) AS Feature")


BLOCK = 240


def reference(spark, sf_dir):
    """Reference blocks, one per part: 240 bases, the part's own position at offset 120 of its block.

    Three blocks in five are ``AG`` repeats throughout, so inserted ``AG`` units move across block edges.
    """
    return table(spark, sf_dir, "part").selectExpr(
        CHROM.format(k="p_partkey") + " AS CHROM",
        f"CAST((p_partkey - p_partkey % 24) / 24 AS BIGINT) AS block",
        f"CAST((p_partkey - p_partkey % 24) * 10 + 1 AS INT) AS start",
        "CASE WHEN p_partkey % 5 < 3 THEN repeat('AG', 120) "
        "ELSE concat(repeat('CTTG', 29), 'TCAG', repeat('AG', CAST(p_partkey % 40 AS INT)), "
        "repeat('GATC', 60)) END AS seq",
    ).withColumn("seq", F.expr(f"substr(seq, 1, {BLOCK})"))


INDEL_FIELDS = {
    "POS": "CAST(start + 118 + pk % 80 AS INT)",
    "off": "POS - start + 1",
    "anchor": "substr(seq, off, 1)",
    "tail": "CASE WHEN pk % 7 = 0 THEN 'T' ELSE '' END",
    "REF": "CASE WHEN pk % 2 = 0 THEN concat(anchor, tail) "
           "ELSE concat(substr(seq, off, CAST(3 + pk % 3 AS INT)), tail) END",
    "ALT": "CASE WHEN pk % 2 = 0 "
           "THEN concat(anchor, CASE pk % 3 WHEN 0 THEN 'AG' WHEN 1 THEN 'GA' ELSE 'CTTG' END, tail) "
           "ELSE concat(anchor, tail) END",
}


def indels(spark, sf_dir):
    """Distinct insertions and deletions that agree with the reference, some padded on the right."""
    out = (
        calls(spark, sf_dir, helper=True).filter("length(ALT) > 1").select("CHROM", "pk").distinct()
        .withColumn("block", F.expr("CAST((pk - pk % 24) / 24 AS BIGINT)"))
        .join(reference(spark, sf_dir), ["CHROM", "block"])
    )
    for name, text in INDEL_FIELDS.items():
        out = out.withColumn(name, F.expr(text))
    return out.select("CHROM", "POS", "REF", "ALT").distinct()
