"""Tables of batches: repeated writes, unfinished attempts, streams beside jobs, compaction."""

import os

import pytest
from helpers import call, calls, records
from pyspark.sql import functions as F
from variantloom import jobs
from variantloom.operators.calls import merge_calls
from variantloom.sinks import batches as B
from variantloom.sinks import tables as W
from variantloom.sinks.text import write_call_tsvs
from variantloom.streaming.ingest import append_batches


def raw(rows):
    return rows.withColumn("AD", F.concat_ws(",", F.col("REF_AD").cast("string"), F.col("ALT_AD").cast("string")))


def test_a_repeated_batch_replaces_its_first_attempt(spark, tmp_path):
    t = f"{tmp_path}/t"
    assert B.committed_batches(spark, t) == [] and B.read_batches(spark, t).count() == 0
    B.write_batch(calls(spark, call(), call(chrom="chr2"), call("S3", chrom="chr3")), t, "a")
    B.write_batch(calls(spark, call("S2")), t, "b")
    B.write_batch(calls(spark, call(), call(chrom="chr2")), t, "a")  # chr3 is gone with the first attempt
    assert records(B.read_batches(spark, t), "SampleID", "CHROM") == [("S1", "chr1"), ("S1", "chr2"), ("S2", "chr1")]
    assert "PartitionFilters: [isnotnull(CHROM" in B.read_batches(spark, t).filter("CHROM = 'chr2'")._jdf.queryExecution().executedPlan().toString()
    os.remove(f"{t}/batch=b/_SUCCESS")  # as of a job that was cut off
    assert B.committed_batches(spark, t) == ["a"] and B.read_batches(spark, t).count() == 2
    with pytest.raises(ValueError, match="not a batch name"):
        B.write_batch(calls(spark, call()), t, "../x")


def test_compaction_keeps_the_rows_at_every_step(spark, tmp_path):
    t = f"{tmp_path}/t"
    for name in "abc":
        B.write_batch(calls(spark, call(name), call(name, chrom="chr2", pos=7)), t, name)
    before = records(B.read_batches(spark, t))
    os.makedirs(f"{t}/batch=all/CHROM=chr1")  # of an attempt that was cut off
    delete, B.drop_replaced = B.drop_replaced, lambda *a: None
    try:
        assert B.compact(spark, t, "all", W.write_calls, merge_calls) == ["a", "b", "c"]
    finally:
        B.drop_replaced = delete
    # the replaced folders are still there and do not count
    assert os.path.exists(f"{t}/batch=a") and B.committed_batches(spark, t) == ["all"] and records(B.read_batches(spark, t)) == before
    B.drop_replaced(spark, t)
    B.drop_replaced(spark, t)
    assert not os.path.exists(f"{t}/batch=a") and records(B.read_batches(spark, t)) == before
    B.write_batch(calls(spark, call("d")), t, "d")
    assert B.committed_batches(spark, t) == ["all", "d"]
    with pytest.raises(ValueError, match="there is a batch"):
        B.compact(spark, t, "all", W.write_calls, merge_calls)
    jobs.main(["compact", t, "all2"], spark)
    assert B.committed_batches(spark, t) == ["all2"] and B.read_batches(spark, t).count() == 7


def test_streams_and_jobs_share_a_table(spark, tmp_path):
    d, rows = str(tmp_path), calls(spark, call(), call("S2", pos=7))
    write_call_tsvs(raw(rows), f"{d}/tsv")
    jobs.main(["calls", f"{d}/tsv", f"{d}/t", "--batch", "job"], spark)
    write_call_tsvs(raw(calls(spark, call("S3"))), f"{d}/new")
    for _ in range(2):
        jobs.main(["stream", f"{d}/new", f"{d}/t", f"{d}/state"], spark)
    assert records(B.read_calls_table(spark, f"{d}/t"), "SampleID") == [("S1",), ("S2",), ("S3",)]
    write_call_tsvs(raw(calls(spark, call("S4"))), f"{d}/new", mode="append")
    append_batches(spark, f"{d}/new", f"{d}/t", f"{d}/state").awaitTermination()
    assert B.read_calls_table(spark, f"{d}/t").count() == 4
    # the last micro-batch again, as after a failure between its rows and its checkpoint
    last = sorted(os.listdir(f"{d}/state/commits"))[-1]
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{d}/state/commits/{name}"):
            os.remove(f"{d}/state/commits/{name}")
    append_batches(spark, f"{d}/new", f"{d}/t", f"{d}/state").awaitTermination()
    assert B.read_calls_table(spark, f"{d}/t").count() == 4
    jobs.main(["genotypes", f"{d}/t", f"{d}/gt"], spark)
    assert spark.read.parquet(f"{d}/gt").count() > 0
