"""Planted passages at both lengths, and the pipeline's edges: clashing columns, repeated rows, empty tables."""

import random

import pytest

import corpus_pipeline
from variantloom.llm import suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def noise(r, size):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))


@pytest.mark.parametrize("size, removed", [(400, 400), (399, 0)])
def test_a_passage_goes_from_400_bytes_on(spark, size, removed):
    r = random.Random(size)
    passage = noise(r, size)
    rows = [(i, noise(r, 300 + i) + f"<{i}" + passage + f"{i}>" + noise(r, 200)) for i in range(3)] + [(9, noise(r, 3000))]
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.n_removed for x in found} == {0: removed, 1: removed, 2: removed, 9: 0}


def test_pipeline_cuts_passages_of_over_50_words(spark):
    r = random.Random(8)
    words = [noise(r, 5).replace(" ", "e") for _ in range(4000)]
    sentence = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = sentence(51)
    assert 250 <= len(passage) < 400
    rows = [(i, sentence(70) + " " + passage + " " + sentence(40 + i), "en", "s", 1) for i in range(3)] + [(5, sentence(200), "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = {x.doc_id: x for x in corpus_pipeline.cut_repeated_passages(spark, docs, "").collect()}
    assert len(kept) == 4 and kept[5].text == rows[3][1]
    assert all(passage not in kept[i].text and kept[i].n_chars == len(kept[i].text) for i in range(3))


def written(spark, folder, rows, labels, extra=()):
    spark.createDataFrame(rows, DOCS).selectExpr("*", *extra).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("rows", [[], [(1, "same text of one line", "en", "s", 3)] * 3 + [(None, None, None, None, None)] * 2 + [(2, "", "en", None, 0)]])
def test_pipeline_with_clashing_columns_empty_and_repeated_rows(spark, tmp_path, rows):
    written(spark, tmp_path, rows, [], ["1 AS n_lines_removed", "'a' AS h", "2 AS k1", "3 AS spans", "4 AS _spans", "'b' AS `row`", "5 AS place", "6 AS component_id", "7 AS fp"])
    columns = spark.read.parquet(f"{tmp_path}/documents.parquet").columns
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name != "packing" and rows:
            assert {x.doc_id for x in docs.select("doc_id").collect()} >= {1}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
