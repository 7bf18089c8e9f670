"""Licence scan through a positional index of rare words.

Each template is a sequence of words with key phrases that are mandatory. The document frequencies of all key words are
counted over the whole table first. A file then looks up only the rarest of a template's key words: each of their
positions in the file, less their place in the phrase, is a possible start of the phrase, and the starts of several
words are intersected. What is left is verified word by word. As every match holds all words of its key phrases,
looking up a few of them misses none.

A template stands at place ``s`` if its first key phrase stands there word by word (``s`` is counted from the template's first
word), each other key phrase stands within ``SLACK`` words of where it should, and ``COVERAGE`` of the template's
words have themselves within ``SLACK`` words of their place, so small insertions and changed words are let through. A
base phrase is a template that is its own key phrase, so its words stand consecutively.

Words are runs of letters and digits after A-Z are lower-cased; every byte beyond ASCII belongs to a word. Null text is empty:
no words, no labels, score 0, null first and last word. The score is the largest share of a template's words found at
any of its places, 1 for a base phrase. Each row gets its own answer, so repeated rows and null ids are kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import functions as F

from variantloom.llm.common import batches

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOOKED_UP = 3
SLACK = 4
COVERAGE = 0.8

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening words of licences and notices, with the phrases that must be there.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted", "without restriction"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify", "without fee"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met",
     ["redistribution and use in source", "conditions are met"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation",
     ["is free software", "gnu general public license"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "gnu affero general public license", ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
]

SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
SCANNED_SQL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
COUNTED = pa.schema([("word", pa.binary()), ("n", pa.int64())])


class Phrase(NamedTuple):
    words: list
    offset: int  # in its template


class Template(NamedTuple):
    label: str
    words: list
    keys: list
    is_base: bool


def templates(base=BASE, notices=NOTICES):
    found = [Template(label, words, [Phrase(words, 0)], True) for words, label in ((p.encode().split(), label) for p, label in base.items())]
    for label, text, keys in notices:
        words = text.encode().split()
        found.append(Template(label, words, [Phrase(k.encode().split(), phrase_offset(words, k.encode().split())) for k in keys], False))
    return found


def phrase_offset(words, phrase):
    for at in range(len(words) - len(phrase) + 1):
        if words[at:at + len(phrase)] == phrase:
            return at
    raise ValueError(f"the template does not hold its key phrase {phrase}")


def file_words(text):
    return WORD.findall((text or b"").lower())


def key_words(known):
    return {w for t in known for k in t.keys for w in k.words}


def count_files(wanted):
    """Function of Arrow batches: how many of a task's files hold each wanted word."""
    def run(source):
        n = Counter()
        for batch in source:
            for text in batch.column("text").to_pylist():
                n.update(wanted.intersection(file_words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], schema=COUNTED)

    return run


def frequencies(rows, known):
    """Files with each key word, over all rows; one number for each key word goes to the driver."""
    counted = rows.mapInArrow(count_files(key_words(known)), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(row["word"]): row["n"] for row in counted.collect()}


def lookups(known, files):
    """Per template and key phrase, the places in the phrase of its rarest words, the rarest first."""
    return [[sorted(range(len(k.words)), key=lambda i: (files.get(k.words[i], 0), i))[:LOOKED_UP] for k in t.keys] for t in known]


def phrase_places(phrase, rare, postings, words):
    """Starts of the phrase in the file: starts that its looked-up words agree on, verified."""
    starts = {p - rare[0] for p in postings[phrase.words[rare[0]]]}
    for i in rare[1:]:
        starts.intersection_update(p - i for p in postings[phrase.words[i]])
    return sorted(s for s in starts if s >= 0 and words[s:s + len(phrase.words)] == phrase.words)


def coverage(template, start, words):
    near = sum(w in words[max(0, start + i - SLACK):max(0, start + i + SLACK + 1)] for i, w in enumerate(template.words))
    return near / len(template.words)


def matches(template, rare, postings, words):
    """``(start, share of the template's words)`` of each place at which the template stands."""
    places = [phrase_places(k, r, postings, words) for k, r in zip(template.keys, rare)]
    for at in places[0]:
        start = at - template.keys[0].offset
        if all(any(abs(p - k.offset - start) <= SLACK for p in found) for k, found in zip(template.keys[1:], places[1:])):
            share = coverage(template, start, words)
            if share >= COVERAGE:
                yield start, share


def scan_file(words, known, rare):
    """``n_base, first, last, base labels, labels, score`` of one file."""
    held = {w for t, r in zip(known, rare) for k, places in zip(t.keys, r) for w in (k.words[i] for i in places)}.intersection(words)
    postings = defaultdict(list)
    if held:
        for place, word in enumerate(words):
            if word in held:
                postings[word].append(place)
    starts, labels, base_labels, score = [], set(), set(), 0.0
    for template, r in zip(known, rare):
        if not all(template.keys[j].words[i] in held for j, places in enumerate(r) for i in places):
            continue
        for start, share in matches(template, r, postings, words):
            labels.add(template.label)
            score = max(score, share)
            if template.is_base:
                starts.append(start)
                base_labels.add(template.label)
    return (len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score)


def scan_files(known, rare):
    """Function of Arrow batches of ``doc_id, text``."""
    def run(source):
        def rows():
            for batch in source:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    words = file_words(text)
                    yield doc_id, len(words), *scan_file(words, known, rare)

        return batches(rows(), SCANNED)

    return run


def scan(docs, known=None, id_col="doc_id", text_col="text"):
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row."""
    known = templates() if known is None else known
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(scan_files(known, lookups(known, frequencies(rows, known))), SCANNED_SQL)
