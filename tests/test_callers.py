"""Two callers from one manifest: calls they share after left-alignment, end to end; the optional part of the entry."""

import gzip
import importlib.util

import __spark_entry__ as entry
import pytest
from helpers import records
from variantloom import jobs
from variantloom.sources.calls import read_call_tsvs

HEAD = "##x\n#CHROM\tPOS\n"


def line(pos, ref, alt, sample="0/1:30:15,15,0:50", contig="chr1"):
    return f"{contig}\t{pos}\t.\t{ref}\t{alt},<NON_REF>\t.\tPASS\t.\tGT:DP:AD:GQ\t{sample}\n"


def gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as file:
        file.write(text)


def test_shared_calls_from_a_manifest(spark, tmp_path, capsys):
    d = str(tmp_path)
    (tmp_path / "g.fa").write_text(">chr1\n" + "CAAAAAAAAAGT" * 5 + "\n")
    (tmp_path / "g.fa.fai").write_text("chr1\t60\t6\t60\t61\n")
    # the same deletion of one A, written at its right and at its left end
    gz(tmp_path / "gatk/a/s.gvcf.gz", HEAD + line(9, "AA", "A") + line(12, "T", "G") + "chr1\t1\n")
    gz(tmp_path / "deepvariant/a/s.gvcf.gz", HEAD + line(1, "CA", "C", "1/1:20:0,20,0:40") + line(11, "G", "T"))
    gz(tmp_path / "gatk/b/s.gvcf.gz", HEAD + line(12, "T", "G") + line(12, "T", "C", contig="chrM"))
    gz(tmp_path / "deepvariant/b/s.gvcf.gz", HEAD + line(12, "T", "G") + line(12, "T", "C", contig="chrM"))
    gz(tmp_path / "gatk/c/s.gvcf.gz", HEAD + line(12, "T", "G"))
    rows = [("A", "gatk/a"), ("A", "deepvariant/a"), ("B", "deepvariant/b"), ("B", "gatk/b"), ("C", "gatk/c"), ("D", "elsewhere/d")]
    (tmp_path / "m.tsv").write_text("sampleID\tPath\n" + "".join(f"{s}\t{d}/{p}/s.gvcf.gz\n" for s, p in rows))
    jobs.main(["reference", f"{d}/g.fa", f"{d}/g.fa.fai", f"{d}/blocks"], spark)
    (tmp_path / "gatk/c").rename(tmp_path / "aside")
    jobs.main(["callers", f"{d}/m.tsv", f"{d}/gatk,{d}/deepvariant", f"{d}/out", "--blocks", f"{d}/blocks"], spark)
    assert records(read_call_tsvs(spark, f"{d}/out"), "SampleID", "CHROM", "POS", "REF", "ALT", "GT", "DP") == [
        ("A", "chr1", 1, "CA", "C", "0/1", 30), ("B", "chr1", 12, "T", "G", "0/1", 30)]
    out = capsys.readouterr().out
    assert "without a file of each caller: 2" in out and "without ten columns: 1" in out and "not there: 0" in out
    jobs.main(["callers", f"{d}/m.tsv", f"{d}/gatk,{d}/deepvariant", f"{d}/plain", "--callers", "deepvariant,gatk"], spark)
    assert records(read_call_tsvs(spark, f"{d}/plain"), "SampleID", "POS") == [("B", 12)]


@pytest.mark.parametrize("module, there", [("json", True), ("no_such_module", False), ("no_such_package.part", False)])
def test_the_entry_asks_whether_a_module_is_there(module, there):
    assert entry._is_there(module) is there and importlib.util.find_spec("json")
