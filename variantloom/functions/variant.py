"""Column expressions for variants, genotypes and consequence classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.text import common_prefix_length, common_suffix_length, item
from variantloom.schemas import SPLICEAI_DELTAS


def variant_id(chrom="CHROM", pos="POS", ref="REF", alt="ALT"):
    return F.concat_ws("_", F.col(chrom), F.col(pos).cast("string"), F.col(ref), F.col(alt))


def annotation_key():
    """Text key of an annotation row; null parts are left out, so it is not a tuple."""
    return F.concat_ws(":", "Location", "Allele", "Gene", "Feature")


def allele_depth(ad, index):
    return item(ad, ",", index).try_cast("int")


def allele_ratio(alt_depth="ALT_AD", depth="DP"):
    return F.try_divide(F.col(alt_depth), F.col(depth))


def allele_class(ref, alt):
    """``snv``, ``indel`` or ``other`` for one REF/ALT pair.

    After the shared prefix and suffix are taken off, an SNV has one base left on each side and an
    indel has nothing left on one side. Symbolic alleles, breakends, ``*``, ``.``, multi-base
    substitutions and mixed changes are ``other``.
    """
    r, a = F.upper(ref), F.upper(alt)
    bases = "^[A-Z]+$"
    # prefix and suffix are measured apart: together they cover the shorter allele of an indel and
    # all but one base of a padded SNV
    shared = common_prefix_length(r, a) + common_suffix_length(r, a)
    shorter = F.least(F.length(r), F.length(a))
    general = (
        F.when(F.length(r) != F.length(a), F.when(shared >= shorter, "indel").otherwise("other"))
        .when(shared == shorter - 1, "snv")
        .otherwise("other")
    )
    # nearly all rows: one base each, told by comparisons instead of two patterns
    one_each = (F.length(r) == 1) & (F.length(a) == 1) & r.between("A", "Z") & a.between("A", "Z") & (r != a)
    return (
        F.when(one_each, F.when(a == "X", "other").otherwise("snv"))
        .when(r.isNull() | a.isNull() | ~r.rlike(bases) | ~a.rlike(bases) | (r == a), "other")
        .when(F.startswith(a, r) | F.startswith(r, a), "indel")
        .otherwise(general)
    )


def genotype_for_allele(gt, allele_number):
    """GT of a multi-allelic record rewritten for one of its ALTs: that ALT is 1, the others 0.

    Phase separators and missing alleles stay as they are, so ``2/3`` gives ``1/0`` for ALT 2.
    """
    number = allele_number.cast("string")

    def recode(allele):
        return F.when(allele == ".", ".").when(allele == number, "1").otherwise("0")

    def recode_token(token):
        return F.concat(recode(F.regexp_extract(token, r"^[0-9.]+", 0)), F.regexp_extract(token, r"[/|]$", 0))

    # two one-character alleles are nearly all genotypes; other ploidies and long numbers are taken apart
    plain = F.concat(recode(F.substring(gt, 1, 1)), F.substring(gt, 2, 1), recode(F.substring(gt, 3, 1)))
    tokens = F.regexp_extract_all(gt, F.lit(r"([0-9.]+[/|]?)"), F.lit(1))
    return F.when(gt.rlike(r"^[0-9.][/|][0-9.]$"), plain).otherwise(
        F.array_join(F.transform(tokens, recode_token), ""))


def any_present(columns):
    """True when at least one of ``columns`` is not null."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()


def variant_type(consequence="Consequence"):
    """Functional class of a consequence list; only an exact ``synonymous_variant`` is Synonymous."""
    whole = F.col(consequence)
    first = item(whole, ",", 0)
    return (
        F.when(whole == "synonymous_variant", "Synonymous")
        .when(first == "stop_gained", "Stop_Gained")
        .when(first == "frameshift_variant", "Frameshift")
        .when(first.isin("splice_acceptor_variant", "splice_donor_variant"), "Splice_variants")
        .when(first == "missense_variant", "Missense")
        .otherwise("Other")
    )


def max_splice_delta():
    return F.greatest(*[F.col(c).try_cast("double") for c in SPLICEAI_DELTAS])


def is_damaging(min_splice=0.8, min_am=0.564):
    """Impact rule per class; a missing score never passes."""
    kind = F.col("Variant_Type")
    return (
        (kind.isin("Stop_Gained", "Frameshift") & (F.col("LoF") == "HC"))
        | ((kind == "Splice_variants") & (F.col("Max_DS_SpliceAI") >= min_splice))
        | ((kind == "Missense") & (F.col("am_pathogenicity") >= min_am))
        | (kind == "Synonymous")
    )
