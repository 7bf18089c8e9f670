"""Left-alignment and trimming of alleles against a reference sequence.

The normal form is that of Tan, Abecasis and Kang (Bioinformatics 2015): an indel moves left while
the base before it equals its last base. Moving one base at a time is the same as matching the
reversed upstream sequence with the reversed indel repeated without end, so the whole move is one
common-prefix length.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from variantloom.functions.text import common_prefix_length, common_suffix_length
from variantloom.operators.joins import splittable_join
from variantloom.schemas import VARIANT_COLUMNS
from variantloom.session import ensure_checkpoint_dir

BLOCK_BP = 960


def _trim(variants):
    """Event form: ``_e`` last base before the event, ``_u`` the bases gained or lost, ``_ins`` which of both."""
    ref, alt = F.upper("REF"), F.upper("ALT")
    longer, shorter = F.greatest(F.length(ref), F.length(alt)), F.least(F.length(ref), F.length(alt))
    # the usual written form starts with all of the shorter allele
    anchored = F.startswith(ref, alt) | F.startswith(alt, ref)
    with_prefix = variants.withColumn("_p", F.when(anchored, shorter).otherwise(common_prefix_length(ref, alt)))
    # the suffix may not reach back into the prefix
    left = shorter - F.col("_p")
    suffix = F.when(left == 0, 0).otherwise(F.least(common_suffix_length(ref, alt), left))
    shorter_first = F.length(alt) > F.length(ref)
    unit = F.when(shorter_first, alt).otherwise(ref)
    return (
        with_prefix.withColumn("_s", suffix)
        .withColumn("_changed", longer - F.col("_p") - F.col("_s"))
        .withColumn("_ins", shorter_first)
        .withColumn("_e", F.col("POS") + F.col("_p") - 1)
        .withColumn("_u", F.substring(unit, F.col("_p") + 1, F.col("_changed")))
    )


def _shift(state, blocks, block_bp):
    """Move each event as far left as its block allows.

    ``_open`` marks those stopped by the block's edge, ``_there`` those whose block exists; the others stay as they are.
    """
    keyed = state.withColumn("_block", F.floor((F.col("_e") - 1) / F.lit(block_bp)))
    # blocks without events leave first: few events are broadcast and the reference is not shuffled, many bring the
    # shuffle that the join after it uses again
    b = blocks.join(keyed.select("CHROM", F.col("_block").alias("block")).distinct(), ["CHROM", "block"], "left_semi").select(
        "CHROM", F.col("block").alias("_block"), F.col("start").alias("_start"), F.col("seq").alias("_seq"))
    found = keyed.join(b, ["CHROM", "_block"], "left").withColumn("_there", F.col("_seq").isNotNull())
    at_edge = F.col("_m") == F.col("_off")
    contig_start = F.col("_start") == 1
    # a move must leave one base before the event: at the contig's first base it stops one earlier
    step = F.when(at_edge & contig_start, F.col("_m") - 1).otherwise(F.col("_m"))
    turn = F.col("_k") % F.col("_size")
    return (
        found.withColumns({"_off": F.col("_e") - F.col("_start") + 1, "_size": F.length("_u")})
        # columns of their own, so that the comparison steps below do not rebuild them; of the endless
        # repeat only as much as the upstream part can match
        .withColumns({"_up": F.reverse(F.substring(F.col("_seq"), F.lit(1), F.col("_off"))),
                      "_endless": F.repeat(F.reverse("_u"), (F.col("_off") / F.col("_size")).cast("int") + 1)})
        .withColumn("_m", common_prefix_length(F.col("_up"), F.col("_endless")))
        .withColumn("_k", step)
        .withColumn("_open", F.coalesce(at_edge & ~contig_start, F.lit(False)))
        .withColumn("_u", F.coalesce(F.concat(F.substring(F.col("_u"), F.col("_size") - turn + 1, turn),
                                              F.substring(F.col("_u"), F.lit(1), F.col("_size") - turn)), F.col("_u")))
        .withColumn("_anchor", F.substring(F.col("_seq"), F.col("_off") - F.col("_k"), F.lit(1)))
        .withColumn("_e", F.coalesce(F.col("_e") - F.col("_k"), F.col("_e")))
        .select(*state.columns, "_anchor", "_open", "_there")
    )


def _moved(closed):
    with_unit = F.concat("_anchor", "_u")
    return closed.select(
        *VARIANT_COLUMNS, F.col("_e").alias("new_POS"),
        F.when(F.col("_ins"), F.col("_anchor")).otherwise(with_unit).alias("new_REF"),
        F.when(F.col("_ins"), with_unit).otherwise(F.col("_anchor")).alias("new_ALT"),
    )


def _unmoved(rows):
    return rows.select(*VARIANT_COLUMNS, *[F.col(c).alias(f"new_{c}") for c in ("POS", "REF", "ALT")])


def _stopped_at_gap(rows):
    """Events that left a block whose predecessor is missing: one step back, onto the block's first base."""
    first = F.substring("_u", 1, 1)
    back = rows.withColumns({"_anchor": first, "_e": F.col("_e") + 1,
                             "_u": F.concat(F.substring(F.col("_u"), F.lit(2), F.length("_u")), first)})
    return _moved(back)


def left_align(variants, blocks, block_bp=BLOCK_BP):
    """Distinct variants with their normal form: ``CHROM, POS, REF, ALT, new_POS, new_REF, new_ALT``.

    Give it the distinct variants of a cohort and join the result back to the calls. SNVs only lose
    padding and never reach the join. ``blocks`` has ``CHROM, block, start, seq``: block ``b`` holds
    positions ``b*block_bp+1`` to ``(b+1)*block_bp`` and may begin earlier (``start``, 1-based).

    An event that matches up to its block's edge goes on in the block before, round by round until
    none is left, so repeats of any length are exact; with overlapping blocks one round is the rule.
    Each round is checkpointed, which keeps the plan short and survives lost executors. Where the
    reference has a gap, events stop at it.
    """
    ensure_checkpoint_dir(variants.sparkSession)
    variants = variants.select(*VARIANT_COLUMNS)
    single = (F.length("REF") == 1) & (F.length("ALT") == 1)
    done = _unmoved(variants.filter(single))
    trimmed = _trim(variants.filter(~single)).checkpoint()
    is_indel = (F.length("REF") != F.length("ALT")) & (
        F.col("_p") + F.col("_s") == F.least(F.length("REF"), F.length("ALT")))
    movable = is_indel & (F.col("_e") >= 1)
    padded = (F.length("REF") == F.length("ALT")) & (F.col("_changed") > 0)
    done = done.unionByName(trimmed.filter(~movable).select(
        *VARIANT_COLUMNS,
        F.when(padded, F.col("POS") + F.col("_p")).otherwise(F.col("POS")).alias("new_POS"),
        *[F.when(padded, F.substring(F.col(c), F.col("_p") + 1, F.col("_changed"))).otherwise(F.col(c))
          .alias(f"new_{c}") for c in ("REF", "ALT")],
    ))
    blocks = blocks.select("CHROM", "block", "start", F.upper("seq").alias("seq"))
    state = trimmed.filter(movable).select(*VARIANT_COLUMNS, "_ins", "_e", "_u")
    leave = _unmoved
    while True:
        moved = _shift(state, blocks, block_bp).checkpoint()
        done = done.unionByName(leave(moved.filter(~F.col("_there")))).unionByName(_moved(moved.filter("_there AND NOT _open")))
        state = moved.filter("_open").select(*state.columns)
        if state.isEmpty():
            return done
        leave = _stopped_at_gap


def align_records(records, blocks, block_bp=BLOCK_BP):
    """Records with POS, REF and ALT in normal form.

    Alleles are aligned once per distinct variant and joined back. Single-base records, nearly all of
    them, take no part in either.
    """
    single = (F.length("REF") == 1) & (F.length("ALT") == 1)
    longer = records.filter(~single)
    aligned = left_align(longer.select(*VARIANT_COLUMNS).distinct(), blocks, block_bp)
    moved = splittable_join(longer, aligned, VARIANT_COLUMNS)
    new = {c: F.col(f"new_{c}") for c in ("POS", "REF", "ALT")}
    return records.filter(single).unionByName(moved.withColumns(new).select(*records.columns))
