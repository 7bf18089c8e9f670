"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents become pieces of at most ``limit`` tokens. Pieces of one length are interchangeable, and so
are gaps of one size, so both are handled as runs: a length, its ranks, a count. Spark ranks the pieces
within their length. A plan over lengths, longest first, then matches runs, on the driver and one after the
other: the pieces of a length go to the smallest gap that holds them; where more pieces than gaps meet, ranks
decide which piece takes which gap, and the rest go to the next larger gap. Pieces that fit no gap open sequences.

The plan's state is a histogram over at most ``limit`` lengths and the runs made from it. Its size depends on
``limit``, not on the corpus. The plan is broadcast; pieces are ranked and joined in Spark. Texts of any length
are tokenized whole by one task, which holds one document's ids.

Null texts are empty texts: a document of the end token alone. Repeated rows are packed one by one.
"""

from __future__ import annotations

import bisect
import functools
import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from variantloom.llm.common import batches, partitions, stored, text_rows
from variantloom.llm.pretokens import SPACED, UNUSUAL, Kept, byte_alphabet

KEPT_PIECES = 1 << 20


class SpacedTokenizer:
    """The ids that the tokenizers library gives, looked up once for each distinct piece of text.

    The file's merges are in the order of their ids, so the same vocabulary as ranks serves single pieces. Unusual
    texts, and files in another order, go through the tokenizers library.
    """

    def __init__(self, path):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ranks = self._ranks(path)
        self.pieces = tiktoken.Encoding("ranks", pat_str=SPACED.pattern, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.kept = Kept(self._piece if ranks else self._whole, KEPT_PIECES)

    @staticmethod
    def _ranks(path):
        """Bytes by id, or None if the ids are not in the order of the merges."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        letters = {c: byte for byte, c in enumerate(byte_alphabet())}
        if made != sorted(set(made)) or any(model["vocab"].get(c, 1 << 30) > made[0] for c in letters):
            return None
        return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= letters.keys() and (len(token) == 1 or i >= made[0]) and i <= made[-1]}

    def _piece(self, piece):
        return np.array(self.pieces.encode_ordinary(piece), "<u4").tobytes()

    def _whole(self, text):
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text):
        """Ids as little-endian unsigned 32-bit bytes."""
        if UNUSUAL.search(text) or any(s in text for s in self.specials):
            return self._whole(text)
        return self.kept.joined(SPACED.findall(text))


@functools.lru_cache(maxsize=2)
def tokenizer(path):
    return SpacedTokenizer(path)


def token_pieces(docs, path, limit=2048, end_id=0, with_ids=False, id_col="doc_id", text_col="text"):
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    Only a document of more than ``limit`` tokens, its end token included, is cut. Its first piece takes
    what does not fill a whole piece.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    spark_type = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int64())))
        spark_type += ", ids array<long>"
    schema = pa.schema(fields)
    end = np.array([end_id], "<u4").tobytes()

    def cut(source):
        bpe = tokenizer(path)
        for batch in source:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.encode(text.as_py()) + end
                total = len(ids) // 4
                start = 0
                for number in range(-(-total // limit)):
                    length = (total - 1) % limit + 1 if number == 0 else limit
                    part = ids[4 * start:4 * (start + length)]
                    row = doc_id, number, start, length, zlib.crc32(part)
                    yield (*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row
                    start += length

    return text_rows(docs, id_col, text_col).mapInArrow(lambda source: batches(cut(source), schema), spark_type)


def best_fit_runs(counts, limit):
    """Best fit, longest first, over ``{length: pieces}``.

    Returns rows ``(length, first_rank, pieces, first_sequence, offset)``: the piece of a length with
    rank ``first_rank + i`` lies in sequence ``first_sequence + i`` at ``offset``.
    """
    gaps, sizes, plan, sequences = {}, [], [], 0

    def add(size, first, count):
        if size:
            if size not in gaps:
                gaps[size] = []
                bisect.insort(sizes, size)
            gaps[size].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                # a new sequence is filled with as many pieces of this length as it holds
                count = max(1, left // (limit // length)) if left >= limit // length else 1
                add(limit, sequences, count)
                sequences += count
                continue
            size = sizes[at]
            first, count = gaps[size].pop()
            taken = min(count, left)
            if count > taken:
                gaps[size].append((first + taken, count - taken))
            if not gaps[size]:
                del gaps[size]
                sizes.pop(at)
            plan.append((length, rank, taken, first, limit - size))
            add(size - length, first, taken)
            rank += taken
            left -= taken
    return plan, sequences


def ranked(pieces):
    """``rank`` of each piece among those of its length, from 0.

    Ranks are counted within buckets of a length, then the smaller buckets' pieces are added, so the pieces of
    a frequent length are sorted by many tasks.
    """
    parts = partitions(pieces)
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("pieces")).select(
        "length", "bucket", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("smaller"))
    return (spread.withColumn("inside", F.row_number().over(inside) - 1)
            .join(sizes, ["length", "bucket"])
            .withColumn("rank", F.col("inside") + F.col("smaller")).drop("bucket", "inside", "smaller"))


def pack(pieces, limit=2048):
    """Give every piece its ``sequence_id`` and ``offset``; other columns stay.

    ``pieces`` needs ``doc_id, piece, start, length, ids_crc32`` with lengths from 1 to ``limit``.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 1 <= length <= limit for length in counts):
        raise ValueError(f"lengths from 1 to {limit} are needed")
    plan, _ = best_fit_runs(counts, limit)
    runs = spark.createDataFrame(plan, "length long, first_rank long, pieces long, first_sequence long, offset long")
    runs = runs.withColumnRenamed("length", "of_length")
    here = (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("first_rank")) & (
        F.col("rank") < F.col("first_rank") + F.col("pieces"))
    return (ranked(pieces).join(F.broadcast(runs), here)
            .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
            .drop("rank", "of_length", "first_rank", "pieces", "first_sequence"))


def pack_documents(docs, path, limit=2048, end_id=0, with_ids=False, id_col="doc_id", text_col="text"):
    """Tokenize, cut and pack: rows of :func:`token_pieces` with ``sequence_id`` and ``offset``."""
    return pack(token_pieces(docs, path, limit, end_id, with_ids, id_col, text_col), limit)
