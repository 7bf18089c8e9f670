"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one vocabulary token can be the last token of the prefix's BPE
encoding. An automaton over the vocabulary lists the tokens that are suffixes of each prefix; a
token is the last one if it is compatible with the last token of the prefix before it, that is, if
no merge across their border would have come first. Back-pointers from the whole word give its ids.

Words are encoded once and kept in a bounded table, so a corpus costs about one look-up a word. Rows
are independent: there is no shuffle, and a lost task is run again on its own split.

Null texts are empty texts; an empty text has no ids and decodes to the empty string.
"""

from __future__ import annotations

import functools
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from variantloom.llm.pretokens import LOWERED, UNUSUAL, Kept, byte_alphabet

# Words kept per worker before the table starts anew: bounds its memory, changes no result.
KEPT_WORDS = 1 << 20
# Last symbols of words lie this far up in the automaton's alphabet.
FINAL = 0xE000
NEVER = 1 << 30


class PrefixEncoder:
    """Encoder and decoder of one tokenizer file with word ends."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.path = path
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {**{i: t for t, i in self.vocab.items()}, **{i: t for t, i in self.specials.items()}}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.alphabet = byte_alphabet()
        self.merges, self.made = {}, {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            parts = self.vocab[left], self.vocab[right]
            self.merges.setdefault(parts, rank)
            self.made.setdefault(self.vocab[left + right], (rank, *parts))
        self.automaton = self._automaton()
        self.compatible = {}
        self.words, self.pieces = Kept(self._word, KEPT_WORDS), Kept(self._piece, KEPT_WORDS)
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self._library = None

    def library(self):
        """The tokenizers library's own view of the file, for unusual texts; made on first use."""
        if self._library is None:
            self._library = Tokenizer.from_file(self.path)
        return self._library

    def _automaton(self):
        machine = ahocorasick.Automaton()
        units = {c: c for c in self.alphabet} | {c + self.suffix: chr(FINAL + i) for i, c in enumerate(self.alphabet)}
        for text, unit in units.items():
            machine.add_word(unit, (self.vocab[text], 1))
        spelled = {self.vocab[text]: unit for text, unit in units.items()}
        for token, (rank, left, right) in sorted(self.made.items(), key=lambda item: item[1][0]):
            # a token that BPE never leaves whole cannot end any prefix
            if left in spelled and right in spelled and self._border_holds(left, right, rank, rank):
                spelled[token] = spelled[left] + spelled[right]
                machine.add_word(spelled[token], (token, len(spelled[token])))
        machine.make_automaton()
        return machine

    def _border_holds(self, left, right, left_until=NEVER, right_until=NEVER):
        """No merge joins ``left`` and ``right``, nor the pieces they were made from, before they are whole.

        Walks back in time: the later of the two tokens is taken apart until both are single symbols.
        Of equal merges the leftmost comes first.
        """
        while True:
            rank = self.merges.get((left, right))
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                left_until, left = a[0], a[2]
            else:
                right_until, right = b[0], b[1]

    def encode_piece(self, piece):
        """Ids of one piece, spelled in the byte alphabet."""
        text = piece[:-1] + chr(FINAL + self.alphabet.index(piece[-1])) if self.suffix else piece
        last, length = [None] * (len(text) + 1), [0] * (len(text) + 1)
        compatible = self.compatible
        for end, (token, size) in self.automaton.iter(text):
            at = end + 1
            if last[at] is not None:
                continue
            if size < at:
                before = last[at - size]
                pair = before << 20 | token
                holds = compatible.get(pair)
                if holds is None:
                    if len(compatible) >= KEPT_WORDS:
                        compatible.clear()
                    holds = compatible[pair] = self._border_holds(before, token)
                if not holds:
                    continue
            last[at], length[at] = token, size
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= length[at]
        return ids[::-1]

    def _piece(self, piece):
        return np.array(self.encode_piece(piece), np.int32).tobytes()

    def _word(self, word):
        return self._piece("".join(map(self.alphabet.__getitem__, word.encode())))

    def _plain(self, text):
        if not UNUSUAL.search(text):
            return self.words.joined(LOWERED.findall(text.lower()))
        library = self.library()
        pieces = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return self.pieces.joined(p for p, _ in pieces)

    def encode(self, text):
        """Ids of a whole text as little-endian int32 bytes."""
        if self.special is None or "<|" not in text:
            return self._plain(text)
        return b"".join(np.int32(self.specials[part]).tobytes() if part in self.specials else self._plain(part)
                        for part in self.special.split(text) if part)

    def decode(self, ids):
        return " ".join(map(self.names.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def encoder(path):
    """One encoder per worker process and file."""
    return PrefixEncoder(path)


def encode(docs, path, id_col="doc_id", text_col="text"):
    """One row per document: ``doc_id``, ``ids`` (array of int). ``path``: a tokenizer file with word ends."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(source):
        bpe = encoder(path)
        for batch in source:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [bpe.encode(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], schema=schema)

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded, path):
    """Rows of :func:`encode` with ``decoded``, the text of the ids; null ids are no ids."""
    rows = encoded.select("doc_id", "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(source):
        bpe = encoder(path)
        for batch in source:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [bpe.decode(ids or ()) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.list_(pa.int32())), pa.array(texts, pa.string())], schema=schema)

    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
