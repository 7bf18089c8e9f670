"""Stand-in views stored as tables, so that a timing is of the library's operators and not of the stand-ins."""

from __future__ import annotations

from variantloom.session import scratch_folder
from variantloom.sinks import tables as W
from variantloom.sources.calls import read_unfiltered


def _stored(spark, df, files):
    path = scratch_folder(spark, "stand-in")
    W.write_plain(df.repartition(files), path)
    return spark.read.schema(df.schema).parquet(path)


def store(spark, sf_dir, files, proxy, queries):
    """Write call rows, gVCF lines, annotator rows and the unfiltered table of ``sf_dir``, and have both modules read them.

    ``unfiltered_db`` goes on joining calls and annotations: a registered table of queries made before keeps the function itself.
    """
    calls = _stored(spark, proxy.calls(spark, sf_dir, helper=True), files)
    proxy.calls = lambda spark, sf_dir, helper=False, lines=None: calls if helper else calls.drop("pk", "sk", "ln")
    for name in ("raw_calls", "gvcf_lines", "vep"):
        rows = _stored(spark, getattr(proxy, name)(spark, sf_dir), files)
        setattr(proxy, name, lambda spark, sf_dir, variants=None, rows=rows: rows)
    path = scratch_folder(spark, "unfiltered")
    W.write_unfiltered(queries._unfiltered(spark, sf_dir), path)
    unfiltered = read_unfiltered(spark, path)
    queries._unfiltered = queries._table = lambda spark, sf_dir: unfiltered
    proxy.calls_and_annotations = lambda spark, sf_dir: (proxy.calls(spark, sf_dir), proxy.annotations(spark, sf_dir))
    proxy.stored = lambda df, name: df
