"""SimHash near-duplicates through fuzzy keys from the binary Golay code.

Fingerprints of 64 bits are cut into three segments. At two differing bits or fewer, one segment agrees
in full, and the next one differs in two bits at most. The Golay code of length 23 makes keys of
that segment: every word's keys are the codewords within four bits of it, one or six of them, and words
within two bits share one (the word between them is within three bits of some codeword, for the
code is perfect). So each fingerprint has for each segment the segment itself with the keys of the
next one; fingerprints that share such a key are verified bit by bit.

Equal fingerprints are one node. Hot keys are cut into cells. Texts that are null or have no words have
fingerprint zero, which links like any other. Repeated rows each get their row. Null ids are kept;
they name no component unless nothing else can, then it is null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from variantloom.llm.common import batches, stored, text_rows
from variantloom.llm.components import cells, components, roots

GENERATOR = 0b101011100011  # of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
LENGTH = 23
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
BLOCK = 3072


def fingerprint(text, seed=42, shingle=3):
    """SimHash over word shingles, repeats included; a bit is set if more than half the hashes have it."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return hashed(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:len(words) - shingle + 1].tolist()
    hashes = np.array([hashed(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs, id_col="doc_id", text_col="text", seed=42, shingle=3):
    """``doc_id, fp``: the fingerprint of each document as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(source):
        for batch in source:
            values = [fingerprint(t.as_py(), seed, shingle) for t in batch.column(1)]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], schema=schema)

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def remainders(words):
    """Words of 23 bits modulo the generator: the syndrome of each, 11 bits."""
    words = np.asarray(words, np.int64).copy()
    for bit in range(LENGTH - 1, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


def error_patterns():
    """By syndrome: the error of at most three bits, and the errors of four bits (five, or none, padded with -1)."""
    single = 1 << np.arange(LENGTH)
    pairs = np.array([a | b for i, a in enumerate(single) for b in single[i + 1:]])
    triples = np.array([p | b for p in pairs for b in single if b > p])
    fours = np.array([t | b for t in triples for b in single if b > t])
    nearest = np.zeros(1 << 11, np.int64)
    for errors in (single, pairs, triples):
        nearest[remainders(errors)] = errors
    further = np.full((1 << 11, 5), -1, np.int64)
    at = remainders(fours)
    order = np.argsort(at, kind="stable")
    at, fours = at[order], fours[order]
    first = np.searchsorted(at, at)
    further[at, np.arange(len(at)) - first] = fours
    # a word within two bits of a codeword shares that one with every word within two bits of it
    further[np.isin(np.arange(1 << 11), remainders(triples), invert=True)] = -1
    return nearest, further


def codeword_keys(words):
    """Row and 12-bit index of every codeword near each word: the nearest, and those at four bits."""
    nearest, further = error_patterns() if not hasattr(codeword_keys, "table") else codeword_keys.table
    codeword_keys.table = nearest, further
    words = np.asarray(words, np.int64)
    at = remainders(words)
    index = [words ^ nearest[at]]
    rows = [np.arange(len(words))]
    for column in further[at].T:
        there = np.flatnonzero(column >= 0)
        rows.append(there)
        index.append(words[there] ^ column[there])
    return np.concatenate(rows), np.concatenate(index) >> 11


def fuzzy_keys(values):
    """Row and key for unsigned fingerprints: a whole segment with a codeword of the next one."""
    segments = [(values >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for i, whole in enumerate(segments):
        row, index = codeword_keys(segments[(i + 1) % 3])
        rows.append(row)
        keys.append(i << 35 | whole[row] << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


def key_rows(distinct):
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(source):
        for batch in source:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 4096):
                part = values[at:at + 4096]
                rows, keys = fuzzy_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], schema=schema)

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def linked_within(bits):
    """Function of one cell: links from each member to the first one it is connected with there."""
    def links(cell):
        values = np.unique(cell["fp"].to_numpy())
        codes = values.view(np.uint64)
        linked = np.empty((len(codes), len(codes)), bool)
        for at in range(0, len(codes), 128):
            linked[at:at + 128] = np.bitwise_count(codes[at:at + 128, None] ^ codes[None, :]) <= bits
        root = roots(linked)
        away = root != np.arange(len(root))
        return pd.DataFrame({"a": values[away], "b": values[root[away]]})

    return links


def near_duplicates(docs, bits=2, id_col="doc_id", text_col="text", seed=42, shingle=3, block=BLOCK):
    """``doc_id, fp, component_id`` of every document; links at ``bits`` (at most 2) differing bits or fewer."""
    if not 0 <= bits <= 2:
        raise ValueError("the keys find up to two differing bits")
    prints = stored(fingerprints(docs, id_col, text_col, seed, shingle))
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    keys = stored(key_rows(first))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    buckets = stored(buckets.filter("members > 1"))
    pairs = buckets.filter((F.col("members") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)).select("a", "b")
    crowded = keys.join(buckets.filter("members > 2").select("key", "members"), "key")
    found = (cells(crowded, "key", "fp", "members", block)
             .groupBy("key", "left", "right").applyInPandas(linked_within(bits), "a long, b long"))
    groups = components(pairs.union(found))
    named = first.join(groups, first["fp"] == groups["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs, bits=2, **options):
    """Rows of ``docs`` without near-duplicates: of each group the document with the smallest id stays.

    Of rows that repeat that id within the group all stay that are equal in text to the first of them.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    groups = near_duplicates(docs, bits, **options)
    kept = groups.filter("doc_id <=> component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
