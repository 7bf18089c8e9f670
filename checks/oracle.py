"""DuckDB SQL for every registered query, written against the given tables.

``calls`` and ``vep`` repeat the stand-in views in SQL; each statement is otherwise independent of
the DataFrame code.
"""

from __future__ import annotations

from checks.proxy import ALT, BLOCK, CHROM, GVCF_FIELDS, INDEL_FIELDS, REF

CALLS = f"""
calls AS (
  SELECT concat('S', CAST(o_custkey AS VARCHAR)) AS SampleID, {CHROM.format(k="l_partkey")} AS CHROM,
    CAST(1000 + l_partkey * 10 AS INT) AS POS, {REF} AS REF, {ALT} AS ALT,
    CASE l_linenumber % 3 WHEN 0 THEN '0/1' WHEN 1 THEN '1/0' ELSE '1/1' END AS GT,
    CASE WHEN d0 = 11 THEN NULL WHEN d0 = 12 THEN 0 ELSE d0 END AS DP,
    CAST(10 + 10 * l_linenumber AS INT) AS GQ,
    d0 - CAST((a0 - a0 % 10) / 10 AS INT) AS REF_AD, CAST((a0 - a0 % 10) / 10 AS INT) AS ALT_AD,
    concat_ws('_', {CHROM.format(k="l_partkey")}, CAST(1000 + l_partkey * 10 AS VARCHAR), {REF}, {ALT}) AS ID,
    l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln
  FROM (SELECT l.*, o.o_custkey, CAST(l.l_quantity AS INT) + 10 AS d0,
          (CAST(l.l_quantity AS INT) + 10) * CAST(round(l.l_discount * 100) AS INT) AS a0
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey))"""

CALL_LIST = "SampleID, CHROM, POS, REF, ALT, GT, DP, GQ, REF_AD, ALT_AD, ID"

VEP = CALLS + """,
vep AS (
  SELECT v.ID, concat(v.CHROM, ':', CAST(v.POS AS VARCHAR)) AS Location,
    CASE WHEN length(v.ALT) > 1 THEN substr(v.ALT, 2) ELSE v.ALT END AS Allele,
    CASE WHEN v.pk % 11 = 0 AND k = 3 THEN NULL ELSE concat('ENSG', CAST(v.pk % 500 AS VARCHAR)) END AS Gene,
    concat('ENST', CAST(v.pk AS VARCHAR), '.', CAST(k AS VARCHAR)) AS Feature,
    CASE (v.pk + k) % 8 WHEN 0 THEN 'synonymous_variant' WHEN 1 THEN 'missense_variant'
      WHEN 2 THEN 'stop_gained,splice_region_variant' WHEN 3 THEN 'frameshift_variant'
      WHEN 4 THEN 'splice_acceptor_variant' WHEN 5 THEN 'splice_donor_variant,intron_variant'
      WHEN 6 THEN 'splice_region_variant,synonymous_variant' ELSE 'intron_variant' END AS Consequence,
    CASE WHEN k = 1 THEN 'YES' END AS CANONICAL,
    CASE WHEN k = 2 AND v.pk % 7 = 0 THEN 'NM_1.1' END AS MANE,
    CASE WHEN v.pk % 9 = 0 THEN NULL ELSE CAST(v.pk % 50 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS MAX_AF,
    CASE WHEN v.pk % 9 = 0 THEN NULL ELSE 'gnomADe_AFR' END AS MAX_AF_POPS,
    CASE WHEN v.pk % 5 = 0 THEN NULL ELSE CAST(v.pk % 40 AS DOUBLE) / CAST(20000 AS DOUBLE) END AS gnomADe_AF,
    CASE WHEN v.pk % 3 = 0 THEN NULL ELSE CAST(v.pk % 30 AS DOUBLE) / CAST(20000 AS DOUBLE) END AS gnomADg_AF,
    CASE WHEN v.pk % 4 = 3 THEN NULL ELSE concat('SYM', CAST(v.pk % 100 AS VARCHAR), '|0.',
      CAST(v.pk % 10 AS VARCHAR), '|0.00|0.', CAST(v.pk % 7 AS VARCHAR), '|0.10|',
      CAST(v.pk % 50 AS VARCHAR), '|-2|3|4') END AS SpliceAI_pred,
    CASE WHEN (v.pk + k) % 8 = 1 THEN CASE WHEN v.pk % 3 = 0 THEN 'likely_pathogenic' ELSE 'ambiguous' END END AS am_class,
    CASE WHEN (v.pk + k) % 8 = 1 THEN CAST(v.pk % 100 AS DOUBLE) / CAST(100 AS DOUBLE) END AS am_pathogenicity,
    CASE WHEN (v.pk + k) % 8 IN (2, 3) THEN CASE WHEN v.pk % 3 = 0 THEN 'LC' ELSE 'HC' END END AS LoF,
    v.CHROM AS Chr
  FROM (SELECT ID, CHROM, POS, REF, ALT, pk, unnest([1, 2, 3]) AS k
        FROM (SELECT DISTINCT ID, CHROM, POS, REF, ALT, pk FROM calls WHERE pk % 13 <> 0)) v)"""

KEYED = "ID, Location, Allele, Gene, Feature"
KEY = "concat_ws(':', Location, Allele, Gene, Feature) AS ID_variant_gene"
PARTS = ", ".join(
    f"string_split(SpliceAI_pred, '|')[{i}] AS {name}"
    for i, name in enumerate(["SYMBOL", "DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL"], 1))

TABLES = VEP + f""",
a_default AS (
  SELECT {KEYED}, Consequence, CANONICAL, MANE, coalesce(MAX_AF, CAST(0 AS DOUBLE)) AS MAX_AF, MAX_AF_POPS, Chr,
    coalesce(greatest(gnomADe_AF, gnomADg_AF), CAST(0 AS DOUBLE)) AS gnomAD_max_AF, {KEY} FROM vep),
a_spliceai AS (SELECT {KEYED}, Chr, {PARTS}, {KEY} FROM vep WHERE SpliceAI_pred IS NOT NULL),
a_alphamissense AS (
  SELECT {KEYED}, am_class, am_pathogenicity, Chr, {KEY} FROM vep
  WHERE am_class IS NOT NULL OR am_pathogenicity IS NOT NULL),
a_loftee AS (
  SELECT {KEYED}, LoF, CAST(NULL AS VARCHAR) AS LoF_filter, CAST(NULL AS VARCHAR) AS LoF_flags,
    CAST(NULL AS VARCHAR) AS LoF_info, Chr, {KEY} FROM vep WHERE LoF IS NOT NULL)"""

ANNOTATIONS = TABLES + """,
annotations AS (
  SELECT d.*, s.SYMBOL, s.DS_AG, s.DS_AL, s.DS_DG, s.DS_DL, s.DP_AG, s.DP_AL, s.DP_DG, s.DP_DL,
    m.am_class, m.am_pathogenicity, l.LoF, l.LoF_filter, l.LoF_flags, l.LoF_info
  FROM (SELECT * FROM a_default WHERE MANE IS NOT NULL OR CANONICAL IS NOT NULL) d
  LEFT JOIN a_spliceai s ON d.ID_variant_gene = s.ID_variant_gene
  LEFT JOIN a_alphamissense m ON d.ID_variant_gene = m.ID_variant_gene
  LEFT JOIN a_loftee l ON d.ID_variant_gene = l.ID_variant_gene)"""

SCORES = f""",
s AS (SELECT {CHROM.format(k='p_partkey')} AS CHROM, CAST(1000 + p_partkey * 10 AS INT) AS POS,
    substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) AS REF, unnest(['A', 'C', 'G', 'T']) AS ALT,
    CAST(p_partkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS am_pathogenicity,
    CASE WHEN p_partkey % 3 = 0 THEN 'likely_pathogenic' ELSE 'ambiguous' END AS am_class FROM part)"""

SCORE_LOOKUP = """,
v AS (SELECT DISTINCT ID, CHROM, POS, REF, ALT FROM calls)
SELECT v.*, s.am_pathogenicity, s.am_class FROM v LEFT JOIN (SELECT * FROM s WHERE REF <> ALT) s
  ON v.CHROM = s.CHROM AND v.POS = s.POS AND v.REF = s.REF AND v.ALT = s.ALT"""

UNFILTERED = ANNOTATIONS + """,
unfiltered AS (
  SELECT c.ID, c.SampleID, c.CHROM, c.POS, c.REF, c.ALT, c.GT, c.DP, c.GQ, c.REF_AD, c.ALT_AD,
    a.Gene, a.Feature, a.Consequence, a.CANONICAL, a.MANE, a.MAX_AF, a.MAX_AF_POPS, a.gnomAD_max_AF,
    a.SYMBOL, a.DS_AG, a.DS_AL, a.DS_DG, a.DS_DL, a.DP_AG, a.DP_AL, a.DP_DG, a.DP_DL,
    a.am_class, a.am_pathogenicity, a.LoF, a.LoF_filter, a.LoF_flags, a.LoF_info
  FROM calls c JOIN annotations a ON c.ID = a.ID AND c.CHROM = a.Chr)"""


def staged(min_samples):
    return UNFILTERED + f""",
n AS (SELECT CHROM, count(DISTINCT SampleID) AS n_samples FROM unfiltered GROUP BY CHROM),
qc AS (
  SELECT *, CAST(ALT_AD AS DOUBLE) / nullif(DP, 0) AS AC_ratio FROM unfiltered
  WHERE DP >= 20 AND GQ >= 30 AND CAST(ALT_AD AS DOUBLE) / nullif(DP, 0) BETWEEN CAST(0.2 AS DOUBLE) AND CAST(0.8 AS DOUBLE)),
freq AS (
  SELECT q.CHROM, POS, REF, ALT, n_samples, CAST(count(DISTINCT SampleID) AS DOUBLE) / (2 * n_samples) AS dataset_AF
  FROM qc q JOIN n ON q.CHROM = n.CHROM GROUP BY q.CHROM, POS, REF, ALT, n_samples),
with_af AS (
  SELECT q.*, f.dataset_AF, f.n_samples FROM qc q
  LEFT JOIN freq f ON q.CHROM = f.CHROM AND q.POS = f.POS AND q.REF = f.REF AND q.ALT = f.ALT),
rare AS (
  SELECT * FROM with_af WHERE gnomAD_max_AF <= CAST(0.001 AS DOUBLE)
    AND (n_samples < {min_samples} OR dataset_AF <= CAST(0.001 AS DOUBLE))),
typed AS (
  SELECT *, CASE WHEN Consequence = 'synonymous_variant' THEN 'Synonymous'
      WHEN f1 = 'stop_gained' THEN 'Stop_Gained' WHEN f1 = 'frameshift_variant' THEN 'Frameshift'
      WHEN f1 = 'splice_acceptor_variant' OR f1 = 'splice_donor_variant' THEN 'Splice_variants'
      WHEN f1 = 'missense_variant' THEN 'Missense' ELSE 'Other' END AS Variant_Type,
    greatest(TRY_CAST(DS_AG AS DOUBLE), TRY_CAST(DS_AL AS DOUBLE), TRY_CAST(DS_DG AS DOUBLE), TRY_CAST(DS_DL AS DOUBLE))
      AS Max_DS_SpliceAI
  FROM (SELECT *, string_split(Consequence, ',')[1] AS f1 FROM rare)),
curated AS (
  SELECT * FROM typed WHERE (Variant_Type IN ('Stop_Gained', 'Frameshift') AND LoF = 'HC')
    OR (Variant_Type = 'Splice_variants' AND Max_DS_SpliceAI >= CAST(0.8 AS DOUBLE))
    OR (Variant_Type = 'Missense' AND am_pathogenicity >= CAST(0.564 AS DOUBLE)) OR Variant_Type = 'Synonymous')"""


SMALL, LARGE = staged(5000), staged(1000)

CURATED_LIST = ("SampleID, CHROM, POS, REF, ALT, GT, DP, GQ, REF_AD, ALT_AD, AC_ratio, Gene, Feature, CANONICAL, MANE, "
                "dataset_AF, gnomAD_max_AF, MAX_AF, MAX_AF_POPS, Variant_Type, am_pathogenicity, Max_DS_SpliceAI")

FUNNEL = """
SELECT CHROM, 1 AS step, 'input' AS stage, 'samples' AS metric, count(DISTINCT SampleID) AS value FROM unfiltered GROUP BY CHROM
UNION ALL SELECT CHROM, 1, 'input', 'variants', count(DISTINCT ID) FROM unfiltered GROUP BY CHROM
UNION ALL SELECT CHROM, 1, 'input', 'pairs', count(DISTINCT (SampleID, ID)) FROM unfiltered GROUP BY CHROM
UNION ALL SELECT u.CHROM, 2, 'qc', 'pairs', coalesce(c, 0) FROM (SELECT DISTINCT CHROM FROM unfiltered) u
  LEFT JOIN (SELECT CHROM, count(DISTINCT (SampleID, ID)) AS c FROM qc GROUP BY CHROM) x ON u.CHROM = x.CHROM
UNION ALL SELECT n.CHROM, 3, CASE WHEN n_samples >= {min_samples} THEN 'rare: gnomAD_max_AF and dataset_AF' ELSE 'rare: gnomAD_max_AF' END,
    'pairs', coalesce(c, 0) FROM n
  LEFT JOIN (SELECT CHROM, count(DISTINCT (SampleID, ID)) AS c FROM rare GROUP BY CHROM) x ON n.CHROM = x.CHROM
UNION ALL SELECT CHROM, 4, 'variant types before impact filter', Variant_Type, count(*) FROM typed GROUP BY CHROM, Variant_Type
UNION ALL SELECT CHROM, 5, 'variant types after impact filter', Variant_Type, count(*) FROM curated GROUP BY CHROM, Variant_Type"""

MANIFEST = """
manifest AS (
  SELECT concat('S', CAST(c_custkey AS VARCHAR)) AS sampleID,
    concat('/data/', c_mktsegment, '/', caller, '/S', CAST(c_custkey AS VARCHAR), '.', caller, '.gvcf.gz') AS Path,
    concat('S', CAST(c_custkey AS VARCHAR), '.', caller, '.gvcf.gz') AS file,
    c_custkey * 2 + CASE caller WHEN 'gatk' THEN 0 ELSE 1 END AS line
  FROM (SELECT *, unnest(['gatk', 'deepvariant']) AS caller FROM customer))"""

_GVCF_SELECT = ",\n    ".join(f"{text} AS {name}" for name, text in GVCF_FIELDS.items())

# The records before splitting, then one row per ALT with recoded genotype and depths. Every stand-in
# genotype is two alleles and one separator, so positions 1 and 3 are the alleles.
RECORDS = CALLS + f""",
records AS (
  SELECT SampleID, f_contig AS CHROM, POS, f_ref AS REF, string_split(f_alts, ',') AS alts, f_gt AS GT, f_dp AS DP,
    string_split(f_ad, ',') AS ads, f_ad AS AD,
    CASE WHEN pk % 3 <> 0 AND sk % 19 = 0 THEN NULL ELSE CAST(GQ AS VARCHAR) END AS GQ
  FROM (SELECT SampleID, CHROM, POS, REF, ALT, GT, DP, GQ, REF_AD, ALT_AD, pk, sk, ln,
    {_GVCF_SELECT} FROM calls)
  WHERE f_alts <> '<NON_REF>'),
split AS (
  SELECT SampleID, CHROM, POS, REF, alts[i] AS ALT,
    CASE WHEN len(alts) = 1 THEN GT ELSE concat(
      CASE substr(GT, 1, 1) WHEN '.' THEN '.' WHEN CAST(i AS VARCHAR) THEN '1' ELSE '0' END, substr(GT, 2, 1),
      CASE substr(GT, 3, 1) WHEN '.' THEN '.' WHEN CAST(i AS VARCHAR) THEN '1' ELSE '0' END) END AS GT,
    DP, CASE WHEN len(alts) = 1 OR len(ads) <> len(alts) + 1 THEN AD ELSE concat(ads[1], ',', ads[i + 1]) END AS AD, GQ
  FROM (SELECT *, unnest(range(1, len(alts) + 1)) AS i FROM records))"""

SITE_FILTER = RECORDS + """,
kept AS (
  SELECT SampleID, CHROM, POS, REF, ALT, GT, CAST(DP AS INT) AS DP, AD, CAST(GQ AS INT) AS GQ FROM split
  WHERE GT NOT IN ('0/0', '0|0', './.', '.|.') AND DP <> '.' AND AD <> '.' AND GQ IS NOT NULL
    AND regexp_full_match(CHROM, 'chr([1-9]|1[0-9]|2[0-2]|X|Y)') AND regexp_full_match(ALT, '[ACGT]+')
    AND ((length(REF) = length(ALT)
          AND len(list_filter(range(1, length(REF) + 1), lambda p: substr(REF, CAST(p AS INT), 1) <> substr(ALT, CAST(p AS INT), 1))) = 1)
      OR (length(ALT) > length(REF) AND len(list_filter(range(0, length(REF) + 1),
          lambda p: concat(substr(ALT, 1, CAST(p AS INT)), substr(ALT, CAST(p AS INT) + length(ALT) - length(REF) + 1)) = REF)) > 0)
      OR (length(ALT) < length(REF) AND len(list_filter(range(0, length(ALT) + 1),
          lambda p: concat(substr(REF, 1, CAST(p AS INT)), substr(REF, CAST(p AS INT) + length(REF) - length(ALT) + 1)) = ALT)) > 0)))"""

_INDEL_SELECT = ", ".join(f"{text} AS {name}" for name, text in INDEL_FIELDS.items())

# One base at a time: while the last bases agree drop them, extending left with the reference when an
# allele would become empty; then drop shared first bases.
LEFT_ALIGN = "WITH RECURSIVE " + CALLS.strip() + f""",
reference AS (
  SELECT {CHROM.format(k="p_partkey")} AS CHROM, CAST((p_partkey - p_partkey % 24) / 24 AS BIGINT) AS block,
    CAST((p_partkey - p_partkey % 24) * 10 + 1 AS INT) AS start,
    substr(CASE WHEN p_partkey % 5 < 3 THEN repeat('AG', 120)
      ELSE concat(repeat('CTTG', 29), 'TCAG', repeat('AG', CAST(p_partkey % 40 AS INT)), repeat('GATC', 60)) END, 1, {BLOCK}) AS seq
  FROM part),
indels AS (
  SELECT DISTINCT CHROM, POS, REF, ALT FROM (
    SELECT CHROM, {_INDEL_SELECT} FROM (
      SELECT i.CHROM, i.pk, r.start, r.seq FROM (SELECT DISTINCT CHROM, pk FROM calls WHERE length(ALT) > 1) i
      JOIN reference r ON i.CHROM = r.CHROM AND CAST((i.pk - i.pk % 24) / 24 AS BIGINT) = r.block))),
walk AS (
  SELECT CHROM, POS, REF, ALT, POS AS p, REF AS r, ALT AS a FROM indels
  UNION ALL
  SELECT w.CHROM, w.POS, w.REF, w.ALT,
    CASE WHEN least(length(r), length(a)) > 1 THEN p ELSE p - 1 END,
    CASE WHEN least(length(r), length(a)) > 1 THEN substr(r, 1, length(r) - 1)
      ELSE concat(substr(f.seq, p - f.start, 1), substr(r, 1, length(r) - 1)) END,
    CASE WHEN least(length(r), length(a)) > 1 THEN substr(a, 1, length(a) - 1)
      ELSE concat(substr(f.seq, p - f.start, 1), substr(a, 1, length(a) - 1)) END
  FROM walk w LEFT JOIN reference f ON w.CHROM = f.CHROM AND CAST(floor((w.p - 2) / {BLOCK}) AS BIGINT) = f.block
  WHERE right(r, 1) = right(a, 1) AND (least(length(r), length(a)) > 1 OR (w.p > 1 AND f.seq IS NOT NULL)))
SELECT CHROM, POS, REF, ALT, p AS new_POS, r AS new_REF, a AS new_ALT
FROM (SELECT *, row_number() OVER (PARTITION BY CHROM, POS, REF, ALT ORDER BY p, length(r)) AS latest FROM walk)
WHERE latest = 1"""

NUMERIC = ["POS", "DP", "GQ", "REF_AD", "ALT_AD", "MAX_AF", "gnomAD_max_AF", "am_pathogenicity"]
CATEGORIES = ["ID", "SampleID", "CHROM", "REF", "ALT", "GT", "Gene", "Feature", "Consequence", "CANONICAL", "MANE",
              "MAX_AF_POPS", "SYMBOL", "DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL",
              "am_class", "LoF", "LoF_filter", "LoF_flags", "LoF_info"]

HISTOGRAM = UNFILTERED + ", vals AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM unfiltered WHERE {c} IS NOT NULL" for c in NUMERIC) + """),
r AS (SELECT "column", min(x) AS mn, max(x) AS mx FROM vals GROUP BY "column")
SELECT "column", CAST(bin AS BIGINT) AS bin, mn + CAST(bin AS BIGINT) * (mx - mn) / CAST(50 AS DOUBLE) AS bin_start, count(*) AS n,
  mn AS min_value, mx AS max_value
FROM (SELECT v."column", mn, mx, floor((x - mn) / CASE WHEN (mx - mn) / CAST(50 AS DOUBLE) = 0 THEN CAST(1 AS DOUBLE)
        ELSE (mx - mn) / CAST(50 AS DOUBLE) END) AS bin
      FROM vals v JOIN r ON v."column" = r."column")
GROUP BY "column", bin, mn, mx"""

TOP = UNFILTERED + ", counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM unfiltered GROUP BY {c}" for c in CATEGORIES) + """)
SELECT "column", value, n, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC NULLS LAST) AS rank FROM counts)
WHERE rank <= 20"""


# Queries that write files and read them again return what the query beside them does.
SAME_ROWS = {"annot_from_tab": "annot_default", "calls_from_tsv": "calls_normalized", "calls_from_gvcf": "sites_variant_filter",
             "unfiltered_roundtrip": "unfiltered_db", "calls_by_batch": "calls_merged",
             "entries_from_files": "entries_flatten", "sites_from_files": "vcf_sites", "annotation_roundtrip": "annot_default",
             "calls_tables": "calls_merged", "curated_roundtrip": "curated_from_unfiltered"}


def oracle_sql():
    sql = _sql()
    return sql | {name: sql[same] for name, same in SAME_ROWS.items()}


def _sql():
    w = "WITH "
    return {
        "manifest_batches": w + MANIFEST + " SELECT sampleID, Path, line, CAST(floor((rn - 1) / 64) AS INT) AS batch FROM "
            "(SELECT *, row_number() OVER (ORDER BY line) AS rn FROM manifest)",
        "manifest_split": w + MANIFEST + " SELECT sampleID, Path, line, "
            "CAST(floor((rn - 1) / ceil(total / CAST(7 AS DOUBLE))) AS INT) + 3 AS batch FROM "
            "(SELECT *, row_number() OVER (ORDER BY line) AS rn, count(*) OVER () AS total FROM manifest)",
        "manifest_resolve": w + MANIFEST + ", staged AS (SELECT concat('S', CAST(o_custkey AS VARCHAR), CASE WHEN o_custkey % 2 = 0 "
            "THEN '.gatk.gvcf.gz' ELSE '.deepvariant.gvcf.gz' END) AS file FROM orders WHERE o_orderstatus = 'F') "
            "SELECT sampleID, file FROM (SELECT *, row_number() OVER (PARTITION BY sampleID ORDER BY line) AS rn FROM manifest "
            "WHERE file IN (SELECT file FROM staged)) WHERE rn = 1",
        "callset_pairing": w + MANIFEST + " SELECT g.sampleID, g.Path AS gatk, d.Path AS deepvariant FROM "
            "(SELECT * FROM manifest WHERE Path LIKE '%gatk%') g JOIN (SELECT * FROM manifest WHERE Path LIKE '%deepvariant%') d "
            "ON g.sampleID = d.sampleID",
        "calls_normalized": w + CALLS + " SELECT SampleID, CHROM, POS, REF, ALT, GT, DP, GQ, REF_AD, "
            "CASE WHEN POS % 70 = 0 THEN NULL ELSE ALT_AD END AS ALT_AD, ID FROM calls",
        "calls_merged": w + CALLS + f" SELECT {CALL_LIST} FROM calls",
        "genotype_counts": w + CALLS + " SELECT SampleID, GT, count(*) AS n_calls, CAST(sum(count(*)) OVER (PARTITION BY SampleID) AS BIGINT) "
            "AS n_records FROM calls GROUP BY SampleID, GT",
        "multiallelic_split": w + RECORDS + " SELECT SampleID, CHROM, POS, REF, ALT, GT, DP, AD, GQ FROM split",
        "sites_variant_filter": w + SITE_FILTER + " SELECT * FROM kept",
        "caller_intersection": w + CALLS + f" SELECT {CALL_LIST} FROM calls c WHERE ln % 2 = 0 AND EXISTS (SELECT 1 FROM calls o "
            "WHERE o.ln % 2 = 1 AND o.SampleID = c.SampleID AND o.CHROM = c.CHROM AND o.POS = c.POS AND o.REF = c.REF AND o.ALT = c.ALT)",
        "entries_flatten": w + CALLS + f" SELECT SampleID, CHROM, POS, REF, ALT, GT, CAST(REF_AD + ALT_AD AS INT) AS DP, GQ, REF_AD, ALT_AD, ID FROM calls "
            "UNION ALL SELECT concat(SampleID, 'h'), CHROM, POS, REF, ALT, '1/1', NULL, 99, NULL, NULL, ID FROM calls",
        "unique_variants": w + CALLS + " SELECT DISTINCT ID, CHROM, POS, REF, ALT FROM calls",
        "variants_per_chrom": w + CALLS + " SELECT coalesce(CHROM, 'all') AS CHROM, count(DISTINCT ID) AS n_variants FROM calls "
            "GROUP BY ROLLUP (CHROM)",
        "vcf_sites": w + CALLS + " SELECT DISTINCT CHROM, POS, ID, REF, ALT, '.' AS QUAL, 'PASS' AS FILTER, '.' AS INFO FROM calls",
        "annot_default": w + TABLES + " SELECT * FROM a_default",
        "annot_spliceai": w + TABLES + " SELECT * FROM a_spliceai",
        "annot_alphamissense": w + TABLES + " SELECT * FROM a_alphamissense",
        "annot_loftee": w + TABLES + " SELECT * FROM a_loftee",
        "primary_transcripts": w + TABLES + " SELECT * FROM a_default WHERE MANE IS NOT NULL OR CANONICAL IS NOT NULL",
        "annot_integrated": w + ANNOTATIONS + " SELECT * FROM annotations",
        "id_coverage": w + ANNOTATIONS + ", c AS (SELECT DISTINCT CHROM, ID FROM calls), a AS (SELECT DISTINCT Chr, ID FROM annotations) "
            "SELECT coalesce(c.CHROM, a.Chr) AS CHROM, count(CASE WHEN c.ID IS NOT NULL AND a.ID IS NOT NULL THEN 1 END) AS shared, "
            "count(CASE WHEN a.ID IS NULL THEN 1 END) AS calls_only, count(CASE WHEN c.ID IS NULL THEN 1 END) AS annotation_only "
            "FROM c FULL JOIN a ON c.CHROM = a.Chr AND c.ID = a.ID GROUP BY 1",
        "unfiltered_db": w + UNFILTERED + " SELECT * FROM unfiltered",
        "cohort_counts": w + UNFILTERED + " SELECT CHROM, 'samples' AS metric, count(DISTINCT SampleID) AS value FROM unfiltered GROUP BY CHROM "
            "UNION ALL SELECT CHROM, 'variants', count(DISTINCT ID) FROM unfiltered GROUP BY CHROM "
            "UNION ALL SELECT CHROM, 'pairs', count(DISTINCT (SampleID, ID)) FROM unfiltered GROUP BY CHROM",
        "curation_funnel": w + LARGE + FUNNEL.format(min_samples=1000),
        "cohort_funnel": w + SMALL + FUNNEL.format(min_samples=5000),
        "qc_filter": w + SMALL + " SELECT * FROM qc",
        "frequencies_by_batch": w + SMALL + " SELECT CHROM, POS, REF, ALT, n_samples, dataset_AF FROM freq",
        "dataset_af": w + SMALL + " SELECT SampleID, ID, Feature, CHROM, POS, REF, ALT, n_samples, dataset_AF FROM with_af",
        "rare_small": w + SMALL + " SELECT SampleID, ID, Feature, CHROM, gnomAD_max_AF, dataset_AF, n_samples FROM rare",
        "rare_large": w + LARGE + " SELECT SampleID, ID, Feature, CHROM, gnomAD_max_AF, dataset_AF, n_samples FROM rare",
        "variant_type": w + SMALL + " SELECT SampleID, ID, Feature, Consequence, Variant_Type FROM typed",
        "variant_type_counts_before": w + SMALL + " SELECT CHROM, Variant_Type, count(*) AS n FROM typed GROUP BY CHROM, Variant_Type",
        "variant_type_counts_after": w + SMALL + " SELECT CHROM, Variant_Type, count(*) AS n FROM curated GROUP BY CHROM, Variant_Type",
        "other_consequences": w + LARGE + " SELECT CHROM, Consequence, count(*) AS n FROM typed WHERE Variant_Type = 'Other' GROUP BY CHROM, Consequence",
        "curated_db": w + SMALL + f" SELECT {CURATED_LIST} FROM curated",
        "curated_large": w + LARGE + f" SELECT {CURATED_LIST} FROM curated",
        "curated_from_unfiltered": w + SMALL + f" SELECT {CURATED_LIST} FROM curated",
        "curated_contigs": w + SMALL + f" SELECT {CURATED_LIST} FROM curated WHERE CHROM IN ('chr2', 'chrX')",
        "manifest_from_file": w + MANIFEST + " SELECT sampleID, Path FROM manifest",
        "sample_total": w + CALLS + " SELECT count(DISTINCT SampleID) AS n_samples FROM calls",
        "report_lines": "SELECT concat_ws(chr(9), CHROM, stage, metric, CAST(value AS VARCHAR)) AS value FROM ("
            + w + LARGE + FUNNEL.format(min_samples=1000) + ")",
        "column_histogram": w + HISTOGRAM,
        "column_top_values": w + TOP,
        "column_top_values_deep": w + TOP.replace("rank <= 20", "rank <= 2000"),
        "score_lookup": w + CALLS + SCORES + SCORE_LOOKUP,
        "score_lookup_stored": w + CALLS + SCORES + SCORE_LOOKUP,
        "score_lookup_transcript": w + VEP + SCORES + """
, v AS (SELECT ID, string_split(ID, '_')[1] AS CHROM, CAST(string_split(ID, '_')[2] AS INT) AS POS, string_split(ID, '_')[3] AS REF,
    string_split(ID, '_')[4] AS ALT, Feature FROM vep),
t AS (SELECT s.*, k, concat('ENST', CAST((POS - 1000) // 10 AS VARCHAR), '.', CAST(k AS VARCHAR)) AS Feature FROM s, range(1, 3) r(k) WHERE REF <> ALT)
SELECT v.ID, v.CHROM, v.POS, v.REF, v.ALT, concat(v.Feature, '.3') AS Feature, t.am_pathogenicity / CAST(k AS DOUBLE) AS am_pathogenicity, t.am_class
FROM v LEFT JOIN t ON v.CHROM = t.CHROM AND v.POS = t.POS AND v.REF = t.REF AND v.ALT = t.ALT AND v.Feature = t.Feature""",
        "left_align": LEFT_ALIGN,
    }
