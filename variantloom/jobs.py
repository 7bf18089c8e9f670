"""Command line: one sub-command per stage, ``spark-submit`` friendly.

    python -m variantloom.jobs batches <manifest> <out>
    python -m variantloom.jobs reference <fasta> <fasta index> <out>
    python -m variantloom.jobs extract <manifest> <gvcf folder,...> <out> [--blocks <reference blocks>] [--short-lines <out>]
    python -m variantloom.jobs extract <batches> <gvcf folder,...> <out> --batch <number> [...]
    python -m variantloom.jobs shared <primary tsv folder> <other tsv folder> <out>
    python -m variantloom.jobs callers <manifest> <gvcf folder,...> <out> [--blocks <reference blocks>] [--callers gatk,deepvariant]
    python -m variantloom.jobs matrix <entries> <out>
    python -m variantloom.jobs calls <tsv folder> <out> [--batch <name>]
    python -m variantloom.jobs stream <tsv folder> <table of batches> <checkpoint>
    python -m variantloom.jobs compact <table of batches> <name>
    python -m variantloom.jobs merge <batch,batch,...> <out>
    python -m variantloom.jobs genotypes <calls> <out>
    python -m variantloom.jobs sites <calls> <out folder>
    python -m variantloom.jobs convert <plugin> <annotator folder> <out>
    python -m variantloom.jobs scores <alphamissense | spliceai> <score file,...> <out>
    python -m variantloom.jobs lookup <alphamissense | spliceai> <calls> <default> <scores> <out>
    python -m variantloom.jobs integrate <calls> <default> <plugin=path,plugin=path,...> <out>
    python -m variantloom.jobs carriers <unfiltered> <cohort> <batch>
    python -m variantloom.jobs curate <unfiltered> <report> <out> [--cohort <cohort>]
    python -m variantloom.jobs cohort <calls> <default> <plugin=path,plugin=path,...> <report> <out>
    python -m variantloom.jobs profile <table> <out>
"""

from __future__ import annotations

import argparse

from pyspark.sql import Observation
from pyspark.sql import functions as F

from variantloom.functions.text import literal_path
from variantloom.operators import curate as C
from variantloom.operators.alleles import BLOCK_BP, align_records
from variantloom.operators.annotations import plugin_table, reshape_annotation
from variantloom.operators.calls import flatten_entries, genotype_counts, intersect_callers, merge_calls, normalize_calls, shared_calls
from variantloom.operators.carriers import carrier_sets, number_samples, sample_sets, stored_frequencies
from variantloom.operators.integrate import annotate_calls, id_coverage, integrate
from variantloom.operators.manifest import assign_batches, pair_callsets, split_batches
from variantloom.operators.profile import histogram, top_values
from variantloom.operators.sites import extract_calls, unique_variants, variants_per_chrom, vcf_rows
from variantloom.plans.cohort import cohort_funnel, curated_cohort
from variantloom.schemas import CANONICAL_CONTIGS
from variantloom.session import scratch_folder, session
from variantloom.sinks import batches as B
from variantloom.sinks import tables as W
from variantloom.sinks.sets import read_sets, write_sets
from variantloom.sinks.text import write_call_tsvs, write_sites
from variantloom.sources.annotations import header_columns, read_annotation_table, read_annotation_tsvs
from variantloom.sources.calls import read_call_tsvs, read_calls, read_curated, read_unfiltered
from variantloom.sources.gvcf import attach_samples, gvcf_files, listed_files, missing_files, parse_gvcf, read_gvcf_lines, unlisted_files
from variantloom.sources.gvcf import short_lines as short_lines_by_file
from variantloom.sources.manifest import read_manifest
from variantloom.sources.matrix import read_entries, row_by_row
from variantloom.sources.reference import read_reference_blocks
from variantloom.sources.score_tables import BUCKETS, PART_BP, store_scores
from variantloom.sources.scores import read_alphamissense_scores, read_spliceai_scores
from variantloom.sources.tables import read_stored_table
from variantloom.streaming.ingest import append_batches


def batches(spark, manifest, out, size=64, count=0, start=0, max_batches=-1):
    """Manifest rows with a batch number: fixed ``--size``, or ``--count`` near-equal batches."""
    rows = read_manifest(spark, manifest)
    W.write_plain(split_batches(rows, count, start) if count else assign_batches(rows, size, max_batches=max_batches), out)


def reference(spark, fasta, index, out, block_bp=BLOCK_BP):
    """FASTA and its index to the reference block table."""
    W.write_plain(read_reference_blocks(spark, fasta, index, block_bp), out)


def extract(spark, manifest, gvcfs, out, blocks=None, block_bp=BLOCK_BP, all_contigs=False, batch=-1, short_lines=None):
    """gVCF files to per-sample call TSVs; ``--blocks`` left-aligns against the reference table.

    ``--batch``: ``manifest`` is the table that ``batches`` wrote, and only the files of this batch are read. Files and lines that are left
    out are counted; ``--short-lines`` stores the counts by file if there are any.
    """
    folders = gvcfs.split(",")
    files = gvcf_files(spark, *folders)
    if batch < 0:
        listed, paths = read_manifest(spark, manifest), folders
        print(f"files not listed in the manifest: {unlisted_files(files, listed).count()}")
    else:
        whole = spark.read.parquet(manifest)
        listed = whole.filter(F.col("batch") == batch)
        # as many paths as a batch has files
        paths = [literal_path(row["path"]) for row in listed_files(files, listed, whole).collect()]
        if not paths:
            raise ValueError(f"none of the files of batch {batch} is below {gvcfs}")
    print(f"listed files that are not there: {missing_files(files, listed).count()}")
    seen, lines = Observation("extract"), read_gvcf_lines(spark, *paths)
    records = extract_calls(parse_gvcf(lines, seen), None if all_contigs else CANONICAL_CONTIGS)
    if blocks:
        # alignment goes over its records several times; the files are read and parsed once
        kept = scratch_folder(spark, "records")
        W.write_plain(records, kept)
        records = align_records(spark.read.schema(records.schema).parquet(kept), spark.read.parquet(blocks), block_bp)
    write_call_tsvs(attach_samples(records, listed), out)
    print(f"lines without ten columns: {seen.get['short_lines']}")
    if short_lines and seen.get["short_lines"]:
        W.write_plain(short_lines_by_file(lines), short_lines)


def shared(spark, primary, other, out):
    """Calls of the first caller that the second one has too."""
    write_call_tsvs(intersect_callers(read_call_tsvs(spark, primary), read_call_tsvs(spark, other)), out)


def callers(spark, manifest, gvcfs, out, blocks=None, block_bp=BLOCK_BP, all_contigs=False, callers="gatk,deepvariant"):
    """Both callers' gVCF files of each sample to the calls that they share, left-aligned before they are compared.

    The manifest lists a file of each caller for a sample, the caller being named in the path. Samples that lack one are counted and
    left out. Files of both callers are one scan, read and parsed once.
    """
    names, listed, folders = callers.split(","), read_manifest(spark, manifest), gvcfs.split(",")
    pairs = pair_callsets(listed, names)
    print(f"samples without a file of each caller: {pairs.filter(' OR '.join(f'`{c}` IS NULL' for c in names)).count()}")
    # one file of each caller and sample; the caller goes with the sample's name
    paired = pairs.dropna().select("sampleID", F.explode(F.array(*[F.struct(F.lit(c).alias("caller"), F.col(c).alias("Path")) for c in names])).alias("one"))
    marked = paired.select(F.concat_ws("\t", "one.caller", "sampleID").alias("sampleID"), "one.Path")
    print(f"listed files that are not there: {missing_files(gvcf_files(spark, *folders), marked).count()}")
    seen, kept = Observation("callers"), scratch_folder(spark, "records")
    records = attach_samples(extract_calls(parse_gvcf(read_gvcf_lines(spark, *folders), seen), None if all_contigs else CANONICAL_CONTIGS), marked)
    parts = F.split("SampleID", "\t", 2)
    records = records.withColumns({"caller": parts[0], "SampleID": parts[1]})
    W.write_plain(records, kept)
    print(f"lines without ten columns: {seen.get['short_lines']}")
    records = spark.read.schema(records.schema).parquet(kept)
    if blocks:
        records = align_records(records, spark.read.parquet(blocks), block_bp)
    write_call_tsvs(shared_calls(records, names), out)


def calls(spark, source, out, batch=None):
    """Call TSVs to the calls table, or to one batch of a table of batches; a batch may be written again."""
    rows = normalize_calls(read_call_tsvs(spark, source))
    B.write_batch(rows, out, batch) if batch else W.write_calls(rows, out)


def stream(spark, source, table, checkpoint, stream_name="stream"):
    """Call files not seen before, as batches of a table."""
    append_batches(spark, source, table, checkpoint, stream_name).awaitTermination()


def compact(spark, table, batch):
    """All batches of a table merged into one, clustered by coordinate."""
    print("batches merged:", len(B.compact(spark, table, batch, W.write_calls, merge_calls)))


def merge(spark, batches, out):
    W.write_calls(merge_calls(read_calls(spark, *batches.split(","))), out)


def matrix(spark, source, out):
    """Matrix export to the calls table, one matrix row in memory at a time."""
    row_by_row(spark)
    W.write_calls(flatten_entries(read_entries(spark, source)), out)


def genotypes(spark, source, out):
    W.write_plain(genotype_counts(B.read_calls_table(spark, source)), out)


def sites(spark, source, out, counts=None, shard_bp=10_000_000, shard_rows=0):
    """Sites VCFs, and the variant counts per chromosome when asked for; ``--shard-rows`` cuts shards of even size."""
    table = B.read_calls_table(spark, source)
    write_sites(vcf_rows(table), out, shard_bp, shard_rows=shard_rows or None)
    if counts:
        W.write_plain(variants_per_chrom(unique_variants(table)), counts)


def convert(spark, plugin, source, out, header_file=None):
    """Annotator output to a table. ``header_file`` names the file whose header gives the column order."""
    columns = header_columns(spark, header_file) if header_file else None
    W.write_annotation_table(reshape_annotation(read_annotation_tsvs(spark, source, plugin, columns), plugin), out)


def scores(spark, plugin, source, out, buckets=BUCKETS, part_bp=PART_BP):
    """Published score files to a table stored for lookups; AlphaMissense by transcript."""
    readers = {"alphamissense": read_alphamissense_scores, "spliceai": read_spliceai_scores}
    store_scores(readers[plugin](spark, *source.split(",")), out, plugin == "alphamissense", buckets, part_bp)


def lookup(spark, plugin, calls_path, default, scores_path, out):
    """A plugin's annotation table from stored scores, for the variants of a calls table and their transcripts."""
    variants = unique_variants(B.read_calls_table(spark, calls_path))
    W.write_annotation_table(plugin_table(read_annotation_table(spark, default, "default"), variants, scores_path, plugin), out)


def _contigs(text):
    """``canonical``, a comma list, or nothing for every contig."""
    return CANONICAL_CONTIGS if text == "canonical" else text.split(",") if text else None


def _integrated(spark, default, plugins, strict_key):
    named = dict(p.split("=", 1) for p in plugins.split(","))
    return integrate(read_annotation_table(spark, default, "default"),
                     [read_annotation_table(spark, path, name) for name, path in named.items()], strict_key)


def unfiltered(spark, calls_path, default, plugins, out, coverage=None, strict_key=False):
    """Calls with annotations; the row count is taken while writing."""
    table = B.read_calls_table(spark, calls_path)
    annotations = _integrated(spark, default, plugins, strict_key)
    written = Observation("integrate")
    W.write_unfiltered(annotate_calls(table, annotations).observe(written, F.count(F.lit(1)).alias("rows")), out)
    print("rows written:", written.get["rows"])
    if coverage:
        W.write_plain(id_coverage(table, annotations), coverage)


def carriers(spark, source, cohort, batch, min_dp=20, min_gq=30, min_ratio=0.2, max_ratio=0.8):
    """Add a batch's carriers and samples to a cohort's stored sets; a batch may be added again."""
    table = read_unfiltered(spark, source)
    known = read_sets(spark, cohort, "numbers")
    new = number_samples(table, known)
    if not new.isEmpty():
        write_sets(new, cohort, "numbers", batch)
    numbers = read_sets(spark, cohort, "numbers")
    write_sets(carrier_sets(table, numbers, min_dp=min_dp, min_gq=min_gq, min_ratio=min_ratio, max_ratio=max_ratio), cohort, "carriers", batch)
    write_sets(sample_sets(table, numbers), cohort, "samples", batch)


def curate(spark, source, report, out, others=None, contigs=None, cohort=None, **thresholds):
    """Curated table, funnel report, and the consequences inside class Other when asked for.

    ``--cohort``: the curated table takes frequencies from the cohort's stored sets, so ``source`` may be a part of the cohort. The report
    and the consequences still count what is in ``source``.
    """
    table = read_unfiltered(spark, source)
    options = dict(contigs=_contigs(contigs), **thresholds)
    # computed once for all three results
    shared, own = scratch_folder(spark, "frequencies"), C.cohort_frequencies(table, **{k: v for k, v in options.items() if k not in ("max_af", "min_samples")})
    W.write_plain(own, shared)
    own = spark.read.schema(own.schema).parquet(shared)
    whole = stored_frequencies(read_sets(spark, cohort, "carriers"), read_sets(spark, cohort, "samples"), options["contigs"]) if cohort else own
    W.write_curated(C.curate(table, frequencies=whole, **options), out)
    W.write_report(C.curation_funnel(table, frequencies=own, **options), report)
    if others:
        W.write_plain(C.other_consequences(table, frequencies=own, **options), others)


def cohort(spark, calls_path, default, plugins, report, out, strict_key=False, contigs=None, **thresholds):
    """Curated table and funnel report straight from calls and annotation tables, without the unfiltered table between."""
    table = B.read_calls_table(spark, calls_path)
    # rows of variants, not of calls; both results read them
    annotations, kept = _integrated(spark, default, plugins, strict_key), scratch_folder(spark, "annotations")
    W.write_plain(annotations, kept)
    annotations = spark.read.schema(annotations.schema).parquet(kept)
    options = dict(contigs=_contigs(contigs), **thresholds)
    W.write_curated(curated_cohort(table, annotations, **options), out)
    W.write_report(cohort_funnel(table, annotations, **options), report)


def profile(spark, source, out, table=None):
    """Histograms and most frequent values; ``--table`` (unfiltered, curated) fixes the schema."""
    readers = {"unfiltered": read_unfiltered, "curated": read_curated}
    table = readers[table](spark, source) if table else read_stored_table(spark, source)
    W.write_plain(histogram(table), f"{out}/histogram")
    W.write_plain(top_values(table), f"{out}/top_values")


def parser():
    p = argparse.ArgumentParser(prog="variantloom")
    sub = p.add_subparsers(dest="stage", required=True)

    def stage(name, run, *positional, **options):
        s = sub.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        for argument in positional:
            s.add_argument(argument)
        for option, default in options.items():
            flag = "--" + option.replace("_", "-")
            if default is False:
                s.add_argument(flag, action="store_true")
            elif default is None or isinstance(default, str):
                s.add_argument(flag, default=default)
            else:
                s.add_argument(flag, type=type(default), default=default)
        s.set_defaults(run=run)

    stage("batches", batches, "manifest", "out", size=64, count=0, start=0, max_batches=-1)
    stage("reference", reference, "fasta", "index", "out", block_bp=BLOCK_BP)
    stage("extract", extract, "manifest", "gvcfs", "out", blocks=None, block_bp=BLOCK_BP, all_contigs=False, batch=-1, short_lines=None)
    stage("shared", shared, "primary", "other", "out")
    stage("callers", callers, "manifest", "gvcfs", "out", blocks=None, block_bp=BLOCK_BP, all_contigs=False, callers="gatk,deepvariant")
    stage("calls", calls, "source", "out", batch=None)
    stage("stream", stream, "source", "table", "checkpoint", stream_name="stream")
    stage("compact", compact, "table", "batch")
    stage("merge", merge, "batches", "out")
    stage("matrix", matrix, "source", "out")
    stage("genotypes", genotypes, "source", "out")
    stage("sites", sites, "source", "out", counts=None, shard_bp=10_000_000, shard_rows=0)
    stage("convert", convert, "plugin", "source", "out", header_file=None)
    stage("scores", scores, "plugin", "source", "out", buckets=BUCKETS, part_bp=PART_BP)
    stage("lookup", lookup, "plugin", "calls_path", "default", "scores_path", "out")
    stage("integrate", unfiltered, "calls_path", "default", "plugins", "out", coverage=None, strict_key=False)
    stage("carriers", carriers, "source", "cohort", "batch", min_dp=20, min_gq=30, min_ratio=0.2, max_ratio=0.8)
    thresholds = dict(denominator="chromosome", max_af=0.001, min_samples=5000, min_dp=20, min_gq=30, min_ratio=0.2, max_ratio=0.8,
                      min_splice=0.8, min_am=0.564)
    stage("curate", curate, "source", "report", "out", others=None, contigs=None, cohort=None, **thresholds)
    stage("cohort", cohort, "calls_path", "default", "plugins", "report", "out", strict_key=False, contigs=None, **thresholds)
    stage("profile", profile, "source", "out", table=None)
    return p


def main(argv=None, spark=None):
    arguments = vars(parser().parse_args(argv))
    run, name = arguments.pop("run"), arguments.pop("stage")
    run(spark or session(f"variantloom {name}"), **arguments)


if __name__ == "__main__":
    main()
