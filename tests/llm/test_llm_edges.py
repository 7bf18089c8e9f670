"""Every registered corpus query over empty tables and over rows of all odd kinds; long texts; plain versions of op6, op8 and op9."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import queries as registered
from test_llm_joins import without_repeats
from variantloom.llm import html_extract, langid, toxicity
from variantloom.llm.words import words

SF = "/root/testdata/sf0.001"
LONG = "long " * 40_000 + "x" * 200_000
TABLES = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long",
                  [(1, "the mit license and a line\nthe mit license and a line", "en", "a", 5), (1, "the mit license and a line\nthe mit license and a line", "en", "a", 5),
                   (1, "another text of one id", "en", "a", 5), (2, None, None, None, None), (None, "no id", "de", "b", 5), (None, None, None, None, None),
                   (3, "", "en", "a", 0), (4, " \n\t\r\n ", "en", "a", 6), (5, LONG, "en", "a", len(LONG)), (6, "a\0b 漢\U0001f600 <|endoftext|>", "zh", "c", 9)]),
    "embeddings": ("vec_id long, embedding array<float>, label int",
                   [(i, [float((i * j) % 7 - 3) for j in range(64)], 1) for i in (0, 50, 50, 51, 51, 100)] + [(None, [1.0] * 64, 1), (None, None, None)]
                   + [(200, [0.0] * 64, 1), (201, [None] + [1.0] * 63, 1), (202, [float("nan")] * 64, 1), (203, [1.0, 2.0], 1), (204, [], None)]),
    "pages": ("page_id long, url string, html string", [(1, "http://a/x", "<p>one</p>"), (1, "http://a/x", "<p>one</p>"), (1, "http://a/y", "<p>two</p>"), (2, None, None),
                                                        (None, "http://b", "<p>three"), (3, "", ""), (4, "http://a/z", "<div><p>" + LONG)]),
    "benchmark": ("bench_id long, text string", [(1, "a question")]),
    "labels": ("doc_id long, quality int, toxic int", [(1, 1, 1), (1, 1, 0), (3, 1, 0), (5, 1, 1), (None, None, None), (6, None, None)]),
    "conversations": ("conv_id long, turn int, role string, text string", [(0, 0, "user", "hi there"), (0, 0, "user", "hi there"), (1, None, None, None), (None, 1, "user", "x"), (21, 1, "user", "")]),
}
CLASHING = ["'p' AS path", "1 AS k1", "2 AS place", "'q' AS line", "3 AS rank", "4 AS score", "5 AS component_id", "'r' AS host", "6 AS salt", "7 AS n", "8 AS fold", "'s' AS `row`"]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    made = {}
    for kind in ("empty", "odd"):
        made[kind] = str(tmp_path_factory.mktemp(kind))
        for name, (schema, rows) in TABLES.items():
            spark.createDataFrame(rows if kind == "odd" else [], schema).selectExpr("*", *CLASHING).write.parquet(f"{made[kind]}/{name}.parquet")
    return made


CORPUS = sorted((n for n in registered() if n.startswith("op") and n[2].isdigit()), key=lambda n: int(n[2:].split("_")[0]))


@pytest.mark.parametrize("name", CORPUS)
def test_empty_tables(spark, folders, name):
    assert registered()[name](spark, folders["empty"]).collect() == []


ROWS_OF = {"op1": "documents", "op2": "embeddings", "op3": "documents", "op6": "pages", "op7": "documents", "op8": "documents", "op9": "documents",
           "op10": "documents", "op12": "documents"}


@pytest.mark.parametrize("name", CORPUS)
def test_odd_rows(spark, folders, name):
    rows = registered()[name](spark, folders["odd"]).collect()
    table = ROWS_OF.get(name.split("_")[0])
    assert rows and (table is None or len(rows) == len(TABLES[table][1]))
    if table:
        id_col = rows[0].__fields__[0]
        key = lambda i: (i is None, i or 0)
        assert sorted((r[id_col] for r in rows), key=key) == sorted((r[0] for r in TABLES[table][1]), key=key)
    # rows that repeat an id and a text have one result
    if table == "documents":
        ones = Counter(tuple(r) for r in rows if r[0] == 1)
        assert sorted(ones.values()) in ([1, 2], [3])


def test_long_pages_are_returned_whole(spark, folders):
    got = [r for r in html_extract.extract(spark.read.parquet(f"{folders['odd']}/pages.parquet")).collect() if r.page_id == 4]
    assert [r.text for r in got] == [LONG]


@pytest.mark.parametrize("host_pages", [5000, 3])
def test_html_equals_a_plain_vote(spark, host_pages, monkeypatch):
    monkeypatch.setattr(html_extract.chosen_paths, "__defaults__", (host_pages,))
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    rows = html_extract.page_rows(pages, "page_id", "url", "html").collect()
    votes, paths = defaultdict(Counter), {}
    for r in rows:
        blocks, containers = html_extract.scored(r.html)
        paths[r.page_id] = {c.path for c in containers}
        if containers:
            votes[r.host][html_extract.best(containers, blocks).path] += 1
    expected = {}
    for r in rows:
        voted = sorted((-votes[r.host][p], p) for p in paths[r.page_id] if votes[r.host][p])
        expected[r.page_id] = html_extract.extract_text(r.html, [p for _, p in voted[:1]])
    assert {r.page_id: r.text for r in html_extract.extract(pages).collect()} == expected and any(expected.values())


def test_language_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    taught, asked = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    model = langid.train(taught, most_rows=10 ** 6, most_words=10 ** 7, most_grams=10 ** 7)
    word_n, gram_n = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for r in taught.filter("lang IS NOT NULL AND text IS NOT NULL").collect():
        word_n[r.lang].update(words(r.text))
    for lang, counts in word_n.items():
        for word, n in counts.items():
            for size in range(1, 5):
                for gram in langid.grams(word, size):
                    gram_n[size][lang][gram] += n
    languages = sorted(word_n)

    def logs(counts, name):
        known = len(set().union(*counts.values()))
        return [math.log((counts[x][name] + 0.5) / (sum(counts[x].values()) + 0.5 * known)) for x in languages]

    seen = set().union(*word_n.values())
    seen_grams = {size: set().union(*by.values()) for size, by in gram_n.items()}
    memo = {}

    def word_score(word):
        if word not in memo:
            memo[word] = [0.0] * len(languages)
            if word in seen:
                memo[word] = logs(word_n, word)
            else:
                for size in (4, 3, 2, 1):
                    found = [g for g in langid.grams(word, size) if g in seen_grams[size]]
                    if found:
                        memo[word] = np.mean([logs(gram_n[size], g) for g in found], axis=0)
                        break
        return memo[word]

    some = asked.filter("text IS NOT NULL").orderBy("doc_id").collect()[:25]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, model).collect()}
    for r in some:
        total = np.sum([word_score(w) for w in words(r.text)], axis=0)
        odds = np.exp(total - total.max())
        assert got[r.doc_id][0] == languages[int(odds.argmax())]
        assert got[r.doc_id][1] == pytest.approx(odds.max() / odds.sum(), abs=1e-3)


def test_toxicity_score_equals_a_plain_sum(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    names = sorted({f for t in list(texts.values())[::9] for w in words(t) for f in toxicity.features(w)})[::3]
    weights = np.random.default_rng(3).normal(size=len(names) + 1) * 0.3
    weight = dict(zip(names, weights))
    for r in toxicity.score(docs, (names, weights)).collect():
        has = {f for w in words(texts[r.doc_id]) for f in toxicity.features(w)}
        expected = 1 / (1 + math.exp(-max(-500, min(500, sum(weight.get(f, 0.0) for f in has) + weights[-1]))))
        assert r.score == pytest.approx(expected, abs=1e-9) and r.predicted == int(r.score >= 0.7)


def test_toxicity_keeps_the_risk_of_negatives_from_falling_below_zero():
    rng = np.random.default_rng(4)
    positive = np.arange(600) < 150
    truly = positive | (rng.random(600) < 0.3)
    has = np.stack([np.where(truly, rng.random(600) < 0.8, rng.random(600) < 0.1), rng.random(600) < 0.5], axis=1)
    rows, columns = np.nonzero(has)
    weights = toxicity.fit(rows, columns, positive, 2, 0.3, 1)
    margin = has @ weights[:2] + weights[2]
    loss = np.logaddexp(0, margin)
    assert weights[0] > 1 > abs(weights[1])
    assert loss[~positive].mean() - 0.3 * loss[positive].mean() > -0.1


def test_pipeline_passages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL")
    rows = docs.orderBy("doc_id").collect()
    expected = list(without_repeats([r.text.encode() for r in rows], corpus_pipeline.PASSAGE_BYTES))
    got = {r.doc_id: r.text for r in corpus_pipeline.cut_repeated_passages(spark, docs, SF).collect()}
    assert [got[r.doc_id] for r in rows] == [e[3].decode("utf-8", "ignore") for e in expected] and any(e[1] for e in expected)
