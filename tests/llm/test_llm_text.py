"""BPE, packing, SimHash, language ID, toxicity and HTML extraction on small tables."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from variantloom.llm import bpe, html_extract, langid, packing, simhash, toxicity
from variantloom.llm.words import bounded_by

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n", "don't 'sss !'s", "é ﬁ ẞ ΣΑΣ İ 漢字 😀 x\x1cy", "a" * 3000, "x<|endoftext|>y <|startoftext|>", "½ ² ٣ 12 345"]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, score string, fp int")


def sample_texts(seed=5, count=60):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("abcdeth in' sSßäö1²!.?\n\t") for _ in range(rnd.randint(0, 80))) for _ in range(count)]


def test_bpe_equals_the_library(spark):
    texts = sample_texts()
    library = Tokenizer.from_file(WORD)
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(documents(spark, texts), WORD), WORD).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(got[i].ids) == ids
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_packing_fills_sequences(spark):
    texts = sample_texts(count=200) + ["word " * 300] * 3
    library = Tokenizer.from_file(BYTE)
    rows = packing.pack_documents(documents(spark, texts), BYTE, limit=64, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts):
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [t for p in pieces for t in p.ids] == [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert all(p.length == 64 for p in pieces[1:]) and [p.start for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces[:-1]]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= 1.05 * -(-total // 64) + 1


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), BYTE).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, linked):
    label = list(range(len(values)))
    for _ in values:
        for i in range(len(values)):
            for j in range(len(values)):
                if linked(values[i], values[j]) and label[j] < label[i]:
                    label[i] = label[j]
    return label


@pytest.mark.parametrize("block", [3072, 2])
def test_simhash_equals_brute_force(spark, block):
    rnd = random.Random(8)
    base = [" ".join(rnd.choice(["aa", "bb", "cc", "dd", "ee"]) for _ in range(40)) for _ in range(6)]
    texts = ODD + base + base[:2] + [b.replace("aa", "aA", 2) + f" x{i}" for i, b in enumerate(base * 5)]
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, texts), block=block).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    expected = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert [got[i].fp & (1 << 64) - 1 for i in range(len(texts))] == prints
    assert [got[i].component_id for i in range(len(texts))] == expected
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, texts)).collect()}
    assert kept == {i for i, c in enumerate(expected) if i == c}


def test_golay_keys_meet_within_two_bits():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        a = int(rnd.integers(1 << 63)) * 2 + 1
        b = a
        for bit in rnd.choice(64, rnd.integers(0, 3), replace=False):
            b ^= 1 << int(bit)
        keys = [set(simhash.fuzzy_keys(np.array([x], np.uint64))[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_simhash_of_no_rows(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_language_by_words_then_grams(spark):
    rows = [(i, "en", "the house and the water") for i in range(20)] + [(20 + i, "de", "das haus und das wasser") for i in range(20)]
    rows += [(50, None, "nothing"), (51, "en", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    got = [(r.lang_pred, r.score) for r in langid.predict(documents(spark, ["the water", "wasserhaus", "watery", None, "12 !", "漢"]), model)
           .orderBy("doc_id").collect()]
    assert [g[0] for g in got] == ["en", "de", "en", "und", "und", "de"]
    assert all(0 <= g[1] <= 1 for g in got) and got[3][1] == 0
    assert langid.train(spark.createDataFrame([], "doc_id long, lang string, text string")) is None
    assert [r.lang_pred for r in langid.predict(documents(spark, ["the"]), None).collect()] == ["und"]


def test_a_rare_language_is_taught_by_all_its_rows(spark):
    rows = [(i, "en", "the house and the water") for i in range(3000)] + [(5000 + i, "de", "das haus und das wasser") for i in range(4)]
    taught = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(taught, most_rows=20)
    assert model.languages == ["de", "en"]
    assert [r.lang_pred for r in langid.predict(documents(spark, ["das wasser", "the water"]), model).orderBy("doc_id").collect()] == ["de", "en"]
    sizes = {r["lang"]: r["count"] for r in bounded_by(taught, 20, "lang", "doc_id").groupBy("lang").count().collect()}
    assert sizes["de"] == 4 and 5 <= sizes["en"] <= 60


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    rnd = random.Random(2)
    plain = lambda: " ".join(rnd.choice("one two three four five six seven".split()) for _ in range(20))
    texts = [plain() + (" grubfoo" if i % 5 == 0 else "") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 200)] + [(None, 1), (5, 1)], "doc_id long, toxic int")
    docs = documents(spark, texts).select("doc_id", "text")
    model = toxicity.train(labels, docs.filter("doc_id < 200"))
    got = {r.doc_id: r for r in toxicity.score(docs.union(spark.createDataFrame([(900, None), (901, "")], docs.schema)), model).collect()}
    held = [got[i].predicted == int(i % 5 == 0) for i in range(200, 400)]
    assert sum(held) >= 198 and got[900].predicted == 0 == got[901].predicted
    assert toxicity.train(labels.filter("toxic = 0"), docs) is None
    kept = toxicity.without_toxic(documents(spark, texts), model)
    assert kept.columns == ["doc_id", "text", "score", "fp"] and 300 <= kept.count() <= 330
    assert toxicity.without_toxic(documents(spark, texts), None).count() == 400


PAGE = """<html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar"><nav><a href=x>Home</a></nav>
<div id="wrap"><div class="post-12 entry"><h2>Tit&eacute;l</h2><p>One  two&nbsp;three <b>bold</b>.<p>Second <a href="q">para</a> graph, longer.
<ul><li>item a<li>item b</ul><div class="share">share</div></div><div class="comments"><p>comment text, longer than all the rest of it put together, and
then some more of it to be sure of that.</p></div></div><div class=cookie-notice>We use</div><footer>f</footer>"""


def test_html_blocks_of_the_article():
    text = "Titél\n\nOne two three bold.\n\nSecond para graph, longer.\n\nitem a\n\nitem b"
    assert html_extract.extract_text(PAGE, []) == text
    assert [html_extract.extract_text(p, ["no/such"]) for p in ("", "plain", "<p>", "<!-- x")] == ["", "plain", "", ""]


def test_html_keeps_every_page(spark):
    pages = [(i, f"http://h{i % 3}.example.com/{i}", PAGE, "extra") for i in range(40)] + [(50, None, None, None), (50, None, None, None), (51, "http://h1.example.com", "")
                                                                                           + ("x",)]
    rows = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string, host string")).collect()
    assert sorted(r.page_id for r in rows) == sorted(p[0] for p in pages)
    assert all(r.text.startswith("Titél") for r in rows if r.page_id < 40) and all(r.text == "" for r in rows if r.page_id >= 50)


@pytest.mark.parametrize("page, text", [
    ("<article><section>" + "long " * 600 + "</section><section>short one</section></article>", "long " * 599 + "long\n\nshort one"),
    ("<article><h1>T</h1><p>intro</p><div class=body><p>" + "body " * 90 + "</p></div></article>", "T\n\nintro\n\n" + "body " * 89 + "body"),
    ("<body><div class=p><h1>T</h1><p>intro</p><div><div class=body>" + "body " * 90 + "</div></div></div></body>", "T\n\nintro\n\n" + "body " * 89 + "body"),
    ("<main><div class=a>one one one</div><div class=b>two</div></main><div class=footer>f</div>", "one one one\n\ntwo"),
])
def test_html_keeps_sections_headings_and_nested_bodies(page, text):
    assert html_extract.extract_text(page, []) == text


def test_html_keeps_short_containers_of_the_voted_path():
    page = "<body><div class=s>" + "long " * 600 + "</div><div class=s>short one</div></body>"
    assert html_extract.extract_text(page, ["body/div.s"]).endswith("long\n\nshort one")


def test_html_matches_a_path_beyond_the_eighth(spark):
    rows = [(100 * k + i, "http://h.example.com/", f"<body><div class=c{'abcdefghi'[k]}>text {k} of a page</div></body>") for k in range(9) for i in range(12 - k)]
    rows += [(900 + i, "http://h.example.com/", "<body><div class=y>one</div><div class=x>two</div></body>") for i in range(3)]
    rows.append((5000, "http://h.example.com/", "<body><div class=z>text</div><div class=x><a href=q>more</a></div></body>"))
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and got[900] == "one\n\ntwo" and got[5000] == "text\n\nmore"


@pytest.mark.parametrize("name", ["content with-sidebar", "has-header", "no-ads", "social-history", "search-results", "notice-of-appeal", "post comments-open"])
def test_html_keeps_a_layout_class_on_a_div(name):
    page = f"<body><div class=menu>m</div><div class='{name}'><h1>T</h1><p>the text of the article</p></div><div class=footer>f</div></body>"
    assert html_extract.extract_text(page, []) == "T\n\nthe text of the article"


def test_html_leaves_out_a_long_advert_beside_an_article():
    page = "<body><div class=ad>" + "buy " * 50 + "</div><article><p>short</p></article></body>"
    assert html_extract.extract_text(page, []) == "short"
