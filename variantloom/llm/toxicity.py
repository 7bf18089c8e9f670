"""Toxicity classifiers by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of all texts is unlabelled, toxic ones among them. A linear model
over the presence of words and word beginnings is trained in numpy on the class-prior-corrected risk: the
positives' loss times the prior, plus the unlabelled texts' loss as negatives less the share that the
prior says is positive. Where that second part falls below zero, the step goes back up, so the model
cannot fit the unlabelled texts beyond what the prior allows. Models from several seeds are averaged.

Training reads bounded samples (``most_positive``, ``most_unlabelled``, in expectation), whose ids are broadcast,
and keeps at most ``most_features`` features, chosen by how far more often positives have them
(a log-likelihood ratio of ``LEAST_RATIO`` or more, so that features rare by chance stay out). The prior is the
toxic share of the labelled training rows unless given.

Null and empty texts have no features and get the score of the bias alone; without a positive every score is 0.
A repeated row gets its score each time. A document with several labels is positive if one of them is.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from variantloom.llm.common import batches, stored, text_rows
from variantloom.llm.words import bounded, words

MOST_POSITIVE, MOST_UNLABELLED, MOST_FEATURES = 6_000, 18_000, 4_096
LEAST_DOCUMENTS, LEAST_RATIO = 3, 10.0
BEGINNINGS = (3, 4, 5, 6)
SEEDS = (1, 2, 3)
STEPS, RATE, DECAY = 400, 0.05, 1e-5
THRESHOLD = 0.7
KEPT_WORDS = 1 << 18


def features(word):
    """The word and its beginnings; a mark keeps a beginning apart from an equal word."""
    return [word, *("^" + word[:size] for size in BEGINNINGS if size < len(word))]


def feature_counts(sample):
    """``feature, positive, unlabelled``: documents of ``positive, text`` that have the feature."""
    schema = pa.schema([("feature", pa.string()), ("positive", pa.int64()), ("unlabelled", pa.int64())])

    def run(source):
        for batch in source:
            counts = Counter()
            for positive, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for feature in {f for w in set(words(text.as_py())) for f in features(w)}:
                    counts[feature, positive] += 1
            names = {f for f, _ in counts}
            yield from batches(((f, counts[f, True], counts[f, False]) for f in names), schema)

    return (sample.select("positive", "text").mapInArrow(run, "feature string, positive long, unlabelled long")
            .groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("unlabelled").alias("unlabelled")))


def choose(counts, positives, unlabelled, most):
    """Features that positives have more often, by the log-likelihood ratio of the two rates."""
    a, b = F.col("positive").cast("double"), F.col("unlabelled").cast("double")
    rate = (a + b) / (positives + unlabelled)
    term = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    ratio = term(a, rate * positives) + term(b, rate * unlabelled)
    rows = (counts.filter((a >= LEAST_DOCUMENTS) & (a * unlabelled > b * positives)).withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
            .orderBy(F.desc("ratio"), "feature").limit(most).select("feature").collect())
    return [r["feature"] for r in rows]


class Vocabulary(dict):
    """Numbers of the features a word has, made on first use in a bounded table."""

    def __init__(self, names):
        super().__init__()
        self.numbers = {name: i for i, name in enumerate(names)}

    def __missing__(self, word):
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = tuple(self.numbers[f] for f in features(word) if f in self.numbers)
        return value

    def of(self, text):
        return sorted(set().union(*map(self.__getitem__, set(words(text)))))


def described(sample, names):
    """``positive, has``: numbers of the features in each text of the sample."""
    schema = pa.schema([("positive", pa.bool_()), ("has", pa.list_(pa.int32()))])

    def run(source):
        vocabulary = Vocabulary(names)
        for batch in source:
            yield from batches(((p, vocabulary.of(t.as_py())) for p, t in zip(batch.column(0).to_pylist(), batch.column(1))), schema)

    return sample.select("positive", "text").mapInArrow(run, "positive boolean, has array<int>")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows, columns, positive, width, prior, seed):
    """Weights and bias of the non-negative risk's minimum, found by Adam on shuffled parts of the sample.

    ``rows, columns``: the features present; ``positive``: one boolean for each row.
    """
    rng = np.random.default_rng(seed)
    count, unlabelled = int(positive.sum()), int((~positive).sum())
    weights, mean, square = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        # half of each class a step
        part = rng.random(len(positive)) < 0.5
        margin = np.bincount(rows, weights[columns], len(positive)) + weights[-1]
        share = sigmoid(margin)
        p, u = part & positive, part & ~positive
        if not p.any() or not u.any():
            p, u = positive, ~positive
        n_p, n_u = p.sum(), u.sum()
        loss = np.logaddexp(0, margin)  # as a negative
        negative_risk = loss[u].sum() / n_u - prior * loss[p].sum() / n_p
        slope = np.zeros(len(positive))
        if negative_risk >= 0:
            slope[p] += prior * (share[p] - 1) / n_p
            slope[u] += share[u] / n_u
            slope[p] -= prior * share[p] / n_p
        else:
            slope[u] -= share[u] / n_u
            slope[p] += prior * share[p] / n_p
        gradient = np.append(np.bincount(columns, slope[rows], width), slope.sum())
        gradient[:-1] += DECAY * weights[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        weights -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return weights


def train(labelled, unlabelled, prior=None, most_positive=MOST_POSITIVE, most_unlabelled=MOST_UNLABELLED,
          most_features=MOST_FEATURES):
    """Model ``(features, weights)`` or None without positives.

    ``labelled``: ``doc_id, toxic`` of the training fold; ``unlabelled``: ``doc_id, text`` of its documents.
    """
    known = labelled.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known)
    toxic = known.filter("toxic = 1").select("doc_id")
    total, positives = known.count(), toxic.count()
    if not positives:
        return None
    if prior is None:
        prior = min(0.9, max(0.001, positives / total))
    chosen = bounded(toxic, most_positive, "doc_id").withColumn("positive", F.lit(True))
    others = bounded(unlabelled.filter("doc_id IS NOT NULL").select("doc_id"), most_unlabelled, "doc_id").distinct()
    others = others.withColumn("positive", F.lit(False))
    # both samples are bounded, and so is the broadcast
    picked = stored(chosen.union(others))
    sample = stored(unlabelled.join(F.broadcast(picked), "doc_id").select("positive", F.coalesce("text", F.lit("")).alias("text")))
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False):
        return None
    names = choose(feature_counts(sample), sizes[True], sizes[False], most_features)
    got = described(sample, names).collect()
    positive = np.array([r["positive"] for r in got])
    sizes = np.array([len(r["has"]) for r in got])
    rows = np.repeat(np.arange(len(got)), sizes)
    columns = np.array([c for r in got for c in r["has"]], np.int64)
    weights = np.mean([fit(rows, columns, positive, len(names), prior, seed) for seed in SEEDS], axis=0)
    return names, weights


def score(docs, model, threshold=THRESHOLD, id_col="doc_id", text_col="text"):
    """``doc_id, score, predicted`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source):
        names, weights = shared.value or ((), np.array([-np.inf]))
        vocabulary = Vocabulary(names)
        for batch in source:
            def rows(batch=batch):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    value = float(sigmoid(weights[vocabulary.of(text.as_py())].sum() + weights[-1]))
                    yield doc_id, value, int(value >= threshold)
            yield from batches(rows(), schema)

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")


def without_toxic(docs, model, threshold=THRESHOLD, text_col="text"):
    """Rows of ``docs`` whose text scores below ``threshold``; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(source):
        names, weights = shared.value or ((), np.array([-np.inf]))
        vocabulary = Vocabulary(names)
        for batch in source:
            keep = [sigmoid(weights[vocabulary.of(t.as_py() or "")].sum() + weights[-1]) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
