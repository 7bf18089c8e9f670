"""Suffix dedup, line dedup, embeddings and top-k against brute force; the pipeline's contract."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from variantloom.llm import embed_dedup, line_dedup, suffix_dedup, topk


def texts(seed):
    r = random.Random(seed)
    word = lambda a, b: "".join(r.choice("abcdeé ") for _ in range(r.randint(a, b)))
    shared = [word(15, 90) for _ in range(8)]
    out = []
    for _ in range(60):
        out.append(word(0, 60) + "".join(r.choice(shared)[r.randint(0, 8):] + word(0, 40) for _ in range(r.randint(0, 3))))
    return out + ["a" * 70, "ab" * 50, "", out[0], out[1], out[2][:50], None, "aab" * 30]


def without_repeats(strings, length):
    seen = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
    for s in strings:
        gone = bytearray(len(s))
        for i in range(len(s) - length + 1):
            if seen[s[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        yield len(s), sum(gone), sum(1 for i in range(len(s)) if gone[i] and (not i or not gone[i - 1])), bytes(c for c, g in zip(s, gone) if not g)


@pytest.mark.parametrize("seed, crowded", [(1, 4096), (2, 1)])
def test_suffix_dedup_equals_brute_force(spark, seed, crowded):
    rows = texts(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, spans string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.without_repeats(docs, 24, 8, crowded).collect()}
    expected = list(without_repeats([(t or "").encode() for t in rows], 24))
    assert [got[i] for i in range(len(rows))] == expected
    cut = {r.doc_id: r.text for r in suffix_dedup.cut_repeats(docs, 24, 8, crowded).collect()}
    assert all(cut[i] == (None if t is None else expected[i][3].decode("utf-8", "ignore")) for i, t in enumerate(rows))


def test_null_ids_whose_texts_share_a_short_hash_keep_their_own_spans(spark):
    # equal under the 32-bit hash() of (null, text)
    repeats, alone = "a passage that two of the rows have in common 107978", "92729 is how a text of its own begins, and it has no copy"
    docs = spark.createDataFrame([(None, repeats), (None, alone), (1, "x a passage that two of the rows have in common ")], "doc_id long, text string")
    got = {bytes(r.kept).decode(): r.n_removed for r in suffix_dedup.without_repeats(docs, 24, 8).collect()}
    assert got == {"107978": 46, alone: 0, "x ": 46}
    assert {r.text for r in suffix_dedup.cut_repeats(docs, 24, 8).collect()} == {"107978", alone, "x "}


def test_suffix_records_do_not_depend_on_the_piece(monkeypatch):
    data = np.frombuffer(("".join(t or "" for t in texts(3))).encode(), np.uint8)
    covered = lambda: sorted(s for at in suffix_dedup.records(data, 24, 8)[2] for s in range(at >> 20, (at >> 20) + (at & 1023) + 1))
    monkeypatch.setattr(suffix_dedup, "PIECE", 37)
    assert covered() == list(range(len(data) - 23))


def test_loser_tree_orders_runs_and_knows_prefixes():
    r = random.Random(3)
    words = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(300)]
    coded = []
    for i in range(7):
        columns = suffix_dedup.front_coded([(w, b"", 0, 0, 0, False) for w in sorted(words[i::7])])
        coded.append((columns[0], suffix_dedup.apart(columns[1], len(columns[0]))))
    out = list(suffix_dedup.merge(coded))
    assert [o[2] for o in out] == sorted(words)
    assert all(b[3] == suffix_dedup.shared_prefix(a[2], b[2]) for a, b in zip(out, out[1:]))


def changed(r, text, edits):
    text = list(text)
    for _ in range(edits):
        at = r.randrange(len(text))
        kind = r.randrange(3)
        if kind == 0:
            text.insert(at, r.choice("abé"))
        elif kind == 1:
            text.pop(at)
        else:
            text[at] = r.choice("abé")
    return "".join(text)


@pytest.mark.parametrize("threshold, block", [(1, 256), (1, 2), (2, 8)])
def test_near_lines_equal_brute_force(spark, threshold, block):
    r = random.Random(4)
    base = ["".join(r.choice("abcdef") for _ in range(r.randint(28, 40))) for _ in range(30)]
    lines = sorted({changed(r, b, r.randint(0, 3)) for b in base for _ in range(4)} | set(base))
    rows = line_dedup.line_rows(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text")
    names = {x.h1: x.line for x in rows.collect()}
    got = {tuple(sorted((names[x.a], names[x.b]))) for x in line_dedup.near_lines(rows, threshold, 30, block).collect()}
    pairs = [(a, b) for a in lines for b in lines if a < b and min(len(a), len(b)) >= 30 and abs(len(a) - len(b)) <= threshold]
    near = spark.createDataFrame(pairs, "a string, b string").filter(F.levenshtein("a", "b") <= threshold).collect()
    assert got == {(x.a, x.b) for x in near} and got


def test_line_dedup_keeps_the_first(spark):
    long = "a line that is long enough to be compared by edits"
    docs = spark.createDataFrame([(1, f"{long}\n\nshort", "p"), (2, f"other\n{long}s\nshort\n", "q"), (3, None, None), (4, "", ""), (None, "short", "n")],
                                 "doc_id long, text string, line string")
    got = {r.doc_id: (r.text, r.line, r.n_lines_removed) for r in line_dedup.dedup_lines(docs).collect()}
    # a null id comes before all others
    assert got == {None: ("short", "n", 0), 1: (f"{long}\n", "p", 1), 2: ("other\n", "q", 2), 3: (None, None, 0), 4: ("", "", 0)}


def test_line_dedup_links_lines_two_edits_apart(spark):
    dated = "Last changed on 2024-03-{} by the editors of this page"
    docs = spark.createDataFrame([(1, dated.format("01")), (2, dated.format("28")), (3, dated.format("28") + "!!")], "doc_id long, text string")
    got = {r.doc_id: r.n_lines_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: 0, 2: 1, 3: 1}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, links int")


ODD = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0]]


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_links_equal_brute_force(spark, block):
    g = np.random.default_rng(1)
    centres = g.normal(size=(12, 16))
    near = np.concatenate([c + g.normal(size=(20, 16)) * s for c, s in zip(centres, np.linspace(0.02, 0.3, 12))]).astype(np.float32)
    near = np.concatenate([near, near[:5], near[5:8] * 2])
    rows = [(i, v.tolist()) for i, v in enumerate(near)] + [(1000 + i, v) for i, v in enumerate(ODD)]
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(vectors(spark, rows), block=block).collect()}
    unit = near.astype(np.float64) / np.linalg.norm(near.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    found = sum(got[i].n_links for i in range(len(near)))
    assert 0.9 * linked.sum() <= found <= linked.sum()  # the index is approximate; nothing below the threshold links
    assert all(got[i].n_links <= linked[i].sum() for i in range(len(near)))
    assert all(got[1000 + i].n_links == 0 and got[1000 + i].component_id == 1000 + i and got[1000 + i].kept for i in range(len(ODD)))
    assert len(got) == len(rows)


def test_a_hot_group_of_near_copies_keeps_its_links(spark):
    g = np.random.default_rng(7)
    hot = g.normal(size=64) + g.normal(size=(1000, 64)) * 0.17
    x = np.concatenate([hot, g.normal(size=(2000, 64))]).astype(np.float32)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = int((unit @ unit.T >= 0.95).sum()) - len(x)
    got = embed_dedup.near_duplicates(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    assert linked > 500_000 and 0.99 * linked <= sum(r.n_links for r in got) <= linked
    assert len({r.component_id for r in got if r.vec_id < 1000}) == 1


def test_one_tight_group_has_one_pivot_and_all_links(spark):
    g = np.random.default_rng(8)
    x = (g.normal(size=16) + g.normal(size=(300, 16)) * 0.01).astype(np.float32)
    got = embed_dedup.near_duplicates(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    assert [r.n_links for r in got] == [299] * 300


def test_topk_equals_brute_force(spark):
    g = np.random.default_rng(2)
    x = np.round(g.normal(size=(230, 16)), 1).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(ODD) if v is None or len(v) != 16 or not np.isfinite(np.array(v, float)).all()]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors(spark, rows), k=4, every=20).collect()]
    q = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    expected = []
    for i in range(0, 230, 20):
        order = sorted((j for j in range(230) if j != i), key=lambda j: (-int(q[i] @ q[j]), j))[:4]
        expected += [(i, n + 1, j, int(q[i] @ q[j])) for n, j in enumerate(order)]
    assert sorted(got) == sorted(expected)


def test_topk_of_repeated_ids_and_rows_without_one(spark):
    rows = [(0, [2.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [9.0, 9.0]), (2, [0.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors(spark, rows), k=5, scale=1, every=2).collect())
    # id 0 asks with (1, 1), id 2 with (0, 1)
    assert got == [(0, 1, 1, 1), (0, 2, 1, 1), (0, 3, 2, 1), (2, 1, 0, 1), (2, 2, 0, 1), (2, 3, 1, 0), (2, 4, 1, 0)]


def test_topk_with_few_rows(spark):
    assert topk.top_k(vectors(spark, [])).collect() == []
    assert [(r.query_id, r.vec_id) for r in topk.top_k(vectors(spark, [(0, [1.0, 2.0]), (3, [1.0, 1.0])])).collect()] == [(0, 3)]


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    r = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(r.choice(words) for _ in range(60)) + (" grubfoo" if i % 6 == 0 else ""), "en", "s", 1) for i in range(150)]
    rows += [(200, rows[1][1], "en", "s", 1), (201, None, None, None, None), (202, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    current, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, current, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        current = spark.read.parquet(f"{tmp_path}/{number}")
        ids[name] = {x.doc_id for x in current.select("doc_id").distinct().collect()}
    toxic = {i for i in range(0, 150, 6)}
    assert len(ids["toxicity"] & toxic) <= 2 and len({x[0] for x in rows} - toxic - ids["toxicity"]) <= 1
    assert ids["line_dedup"] == ids["toxicity"] and ids["suffix_dedup"] == ids["simhash"] == ids["packing"]
    # 200 repeats document 1: its line went, and of the empty texts the smallest id stays
    assert 1 in ids["simhash"] and 200 in ids["simhash"] and not ids["simhash"] & {201, 202}


@pytest.mark.parametrize("spread", [0.02, 5.0])
def test_topk_multiplies_less_than_all(spread):
    g = np.random.default_rng(5)
    centres = g.normal(size=(40, 64))
    v = np.floor(256 * np.concatenate([centres + g.normal(size=(40, 64)) * spread for _ in range(20)])).astype(np.int64)
    ids, q = np.arange(len(v)), v[:64]
    scores = np.where(np.arange(64)[:, None] == ids[None, :], -(1 << 55), q @ v.T)
    bound = np.sort(scores, axis=1)[:, -5]
    rows, found_ids, found, work = topk.resolve(q, ids[:64], bound, v, ids, 5)
    expected = [(i, j, scores[i, j]) for i in range(64) for j in sorted(ids, key=lambda j: (-scores[i, j], j))[:5]]
    assert list(zip(rows, found_ids, found)) == expected
    assert work < q.size * len(ids) * (0.35 if spread < 1 else 0.9)


def test_topk_counts_its_work_and_needs_no_gathered_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 20)
    monkeypatch.setattr(topk, "GATHERED", 1000)
    g = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(g.normal(size=(200, 16)))]
    counted = spark.sparkContext.accumulator(0)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(vectors(spark, rows), every=10, multiplied=counted).collect()}
    x = np.floor(256 * np.array([v for _, v in rows]).astype(np.float32).astype(np.float64)).astype(np.int64)
    for i in range(0, 200, 10):
        order = sorted((j for j in range(200) if j != i), key=lambda j: (-int(x[i] @ x[j]), j))[:5]
        assert [got[i, n + 1] for n in range(5)] == [(j, int(x[i] @ x[j])) for j in order]
    assert 0 < counted.value < 2 * 20 * 200 * 16
