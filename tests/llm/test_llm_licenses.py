"""op12: equal to templates held against every word of every text; edges of the input."""

import re

from variantloom.llm import licenses

SCHEMA = "doc_id long, text string, n_words int, score string, word string"


def brute(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, base, labels, score = [], set(), set(), 0.0

    def stands(phrase, at):
        return at >= 0 and words[at:at + len(phrase)] == phrase

    for phrase, label in licenses.BASE.items():
        found = [i for i in range(len(words)) if stands(phrase.split(), i)]
        if found:
            starts += found
            base.add(label)
            labels.add(label)
            score = 1.0
    for label, template, keys in licenses.NOTICES:
        want, keys = template.split(), [k.split() for k in keys]
        offsets = [next(i for i in range(len(want)) if want[i:i + len(k)] == k) for k in keys]
        for s in range(-offsets[0], len(words)):
            if stands(keys[0], s + offsets[0]) and all(
                    any(stands(k, s + o + d) for d in range(-4, 5)) for k, o in zip(keys[1:], offsets[1:])):
                near = sum(w in words[max(0, s + i - 4):max(0, s + i + 5)] for i, w in enumerate(want)) / len(want)
                if near >= 0.8:
                    labels.add(label)
                    score = max(score, near)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def check(spark, texts):
    rows = [(i, t, 1, "s", "w") for i, t in enumerate(texts)]
    found = licenses.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((r[0], *r[1:]) for r in found) == [(i, *brute(t)) for i, t in enumerate(texts)]
    return {r["doc_id"]: r for r in found}


MIT = next(n[1] for n in licenses.NOTICES if n[0] == "mit")


def test_phrases_notices_and_changed_words(spark):
    found = check(spark, [
        "Released under the MIT License.", "the mit licensed, not mit-License? mit/license", "CC-BY-NC 4.0 and CC BY; licensed under CC BY-NC 4.0",
        "This work is licensed under the GNU General Public License, version 3.", "GNU General Public\nLICENSE gnu general public license",
        MIT, MIT.replace("charge", "cost").replace("software and", "software, tools and"), MIT.replace("without restriction", "without any"),
        MIT.upper() + " x " + MIT, "apache  license apache license, VERSION 2.0", "Licensed under the Apache License, Version 2.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published",
        "permission is hereby granted " * 30, "Émit license", "mit license", "gnu general public", "mit", "cc by cc by cc by nc"])
    assert found[0]["labels"] == "mit" and found[2]["base_labels"] == "cc-by" and found[2]["labels"] == "cc-by,cc-by-nc"
    assert found[6]["labels"] == "mit" and 0.8 <= found[6]["score"] < 1 and found[7]["labels"] == ""


def test_edges(spark):
    long = "word " * 300_000 + "mit license " + "w" * 200_000 + " mit license"
    found = check(spark, [None, "", " \n\t", "...", long, "mit license " * 20_000])
    assert found[0]["first_word"] is None and found[0]["n_words"] == 0 and found[0]["score"] == 0
    assert found[4]["first_word"] == 300_000 and found[5]["n_base"] == 20_000


def test_repeats_null_ids_and_empty_table(spark):
    rows = [(1, "MIT License", 0, "", ""), (1, "MIT License", 0, "", ""), (None, "MIT License", 0, "", ""), (1, None, 0, "", "")]
    found = licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] or -1, r["labels"]) for r in found) == [(-1, "mit"), (1, ""), (1, "mit"), (1, "mit")]
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_looks_up_the_rarest_words(spark):
    known = licenses.templates()
    rare = licenses.lookups(known, {b"license": 9, b"mit": 1})
    assert rare[3] == [[0, 1]] and known[3].label == "mit"
    files = licenses.frequencies(spark.createDataFrame([("mit mit license",), ("license",), (None,)], "text string").selectExpr("cast(text as binary) text"), known)
    assert files[b"license"] == 2 and files[b"mit"] == 1
