"""Language identification by words first, backing off to character n-grams.

A word seen in training scores by its log frequency in each language. A word that was not seen scores by the
longest of its character n-grams that were: those of ``order`` characters, else shorter ones, down to single
characters; a word with none says nothing. A text's score in a language is the sum over its words.

Training reads a bounded sample of the labelled rows of each language (``most_rows`` of each, in expectation, and all
rows of a language that has fewer); the model keeps the
most frequent words and n-grams up to ``most_words`` and ``most_grams``, which bounds what is broadcast.
Rarer words fall to their n-grams, so no word of any text goes unscored for that.

Texts that are null or without a letter get ``und`` and score 0, as do all texts if no row has a label. Letters
of which nothing was learned leave all languages equal; ties go to the first language by name. Repeated rows
count as often as they are there; rows without language or text teach nothing.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from variantloom.llm.common import batches, stored, text_rows
from variantloom.llm.words import bounded_by, has_letter, words

# Of each language.
MOST_ROWS = 2_500
MOST_WORDS, MOST_GRAMS = 100_000, 200_000
ORDER = 4
SMOOTHING = 0.5
KEPT_WORDS = 1 << 18


def grams(word, order):
    """N-grams of a word between its borders."""
    edged = f"\x02{word}\x03"
    return [edged[i:i + order] for i in range(len(edged) - order + 1)]


def word_counts(labelled):
    """``lang, word, n`` over ``lang, text``: counted within batches, then summed."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(source):
        for batch in source:
            counts = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update((lang, w) for w in words(text.as_py()))
            yield from batches(((lang, w, n) for (lang, w), n in counts.items()), schema)

    return labelled.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


def gram_counts(counts, order):
    """``lang, gram, n`` of all orders up to ``order``, over the rows of :func:`word_counts`."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def run(source):
        for batch in source:
            sums = Counter()
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for size in range(1, order + 1):
                    for gram in grams(word, size):
                        sums[lang, gram] += n
            yield from batches(((lang, g, n) for (lang, g), n in sums.items()), schema)

    return counts.select("lang", "word", "n").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def most_frequent(counts, name, most):
    """Counts by language of the ``most`` most frequent names, ties by name: ``{name: {lang: n}}``."""
    rows = (counts.groupBy(name).agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("total"))
            .orderBy(F.desc("total"), name).limit(most).select(name, "by").toLocalIterator())
    return {r[name]: r["by"] for r in rows}


class Model:
    """Log frequencies by language; picklable and bounded."""

    def __init__(self, languages, known_words, known_grams, order):
        self.languages, self.order = languages, order
        self.words = self._logs(known_words)
        self.grams = {}
        for size in range(1, order + 1):
            self.grams |= self._logs({g: by for g, by in known_grams.items() if len(g) == size})

    def _logs(self, counts):
        if not counts:
            return {}
        table = np.array([[by.get(lang, 0) for lang in self.languages] for by in counts.values()], np.float64) + SMOOTHING
        table = np.log(table) - np.log(table.sum(axis=0, keepdims=True))
        return dict(zip(counts, table.astype(np.float32)))

    def word(self, word):
        found = self.words.get(word)
        if found is not None:
            return found
        for size in range(min(self.order, len(word) + 2), 0, -1):
            seen = [self.grams[g] for g in grams(word, size) if g in self.grams]
            if seen:
                return np.mean(seen, axis=0)
        return np.zeros(len(self.languages), np.float32)


class Scorer(dict):
    """Row of each word's scores in a bounded table, made on first use."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.table = np.zeros((KEPT_WORDS, len(model.languages)), np.float32)

    def __missing__(self, word):
        row = self[word] = len(self)
        self.table[row] = self.model.word(word)
        return row

    def score(self, text):
        """Language and posterior, all languages being equally likely beforehand."""
        total = np.zeros(len(self.model.languages))
        found = words(text)
        for at in range(0, len(found), KEPT_WORDS // 2):
            part = found[at:at + KEPT_WORDS // 2]
            if len(self) + len(part) > KEPT_WORDS:
                self.clear()
            total += self.table[np.fromiter(map(self.__getitem__, part), np.int64, len(part))].sum(axis=0, dtype=np.float64)
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def train(labelled, most_rows=MOST_ROWS, most_words=MOST_WORDS, most_grams=MOST_GRAMS, order=ORDER):
    """Model from rows of ``doc_id, lang, text``; None if no row has both a language and a text."""
    usable = labelled.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = stored(word_counts(bounded_by(usable, most_rows, "lang", "doc_id")))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    return Model(languages, most_frequent(counts, "word", most_words),
                 most_frequent(gram_counts(counts, order), "gram", most_grams), order)


def predict(docs, model, id_col="doc_id", text_col="text"):
    """``doc_id, lang_pred, score`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source):
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in source:
            def rows(batch=batch):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    text = text.as_py()
                    if scorer is None or text is None or not has_letter(text):
                        yield doc_id, "und", 0.0
                    else:
                        yield doc_id, *scorer.score(text)
            yield from batches(rows(), schema)

    return text_rows(docs, id_col, text_col, None).mapInArrow(run, "doc_id long, lang_pred string, score double")
