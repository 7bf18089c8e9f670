"""Cut text into the pieces that the public tokenizer files encode one by one.

A plain pattern serves texts of ASCII and Latin letters. Any other text goes through the tokenizer
file's own normalizer and splitter, so every text is cut exactly as the file says.
"""

from __future__ import annotations

import re

LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"
DIGITS = "0-9²³¹¼-¾"
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-įı-ɏ]")
CONTRACTIONS = "'(?:s|t|re|ve|m|ll|d)"

# The two splitters, as the tokenizer files state them, over the letters and digits above.
SPACED = re.compile(rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+")
LOWERED = re.compile(rf"{CONTRACTIONS}|[{LETTERS}]+|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+")


def byte_alphabet():
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for byte in range(256):
        if byte not in table:
            table[byte] = chr(256 + len(table) - len(plain))
    return [table[b] for b in range(256)]


class Kept(dict):
    """Encoded bytes by piece, made on first use; starts anew after ``most`` pieces to bound memory."""

    def __init__(self, encode, most):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.encode(key)
        return value

    def joined(self, keys):
        return b"".join(map(self.__getitem__, keys))
