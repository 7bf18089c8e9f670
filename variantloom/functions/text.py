"""Column helpers over strings: shared prefixes and FORMAT fields."""

from __future__ import annotations

import re

from pyspark.sql import functions as F


def common_prefix_length(a, b):
    """Length of the longest common prefix of two string columns.

    "Equal up to n characters" is monotone in n, so the answer is built bit by bit, one substring
    comparison per binary digit of the shorter length.
    """
    limit = F.least(F.length(a), F.length(b))
    powers = F.sequence(F.length(F.bin(limit)) - 1, F.lit(0), F.lit(-1))

    def extend(n, power):
        step = F.call_function("shiftleft", F.lit(1), power)
        equal = (n + step <= limit) & (F.substring(a, n + 1, step) == F.substring(b, n + 1, step))
        return F.when(equal, n + step).otherwise(n)

    return F.aggregate(powers, F.lit(0), extend)


def common_suffix_length(a, b):
    return common_prefix_length(F.reverse(a), F.reverse(b))


def format_field(fmt, sample, name):
    """Value of FORMAT key ``name`` in a ``:``-joined sample column; null if absent or dropped off the end."""
    position = F.array_position(F.split(fmt, ":"), name).cast("int")
    return F.get(F.split(sample, ":"), position - 1)


def item(text, separator, index):
    """Part ``index`` of a split string, null when there are fewer parts."""
    return F.get(F.split(text, separator), F.lit(index))


def decoded_path(path):
    """Plain text of a percent-encoded file URI part; ``+`` is an ordinary character in a path."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal_path(path):
    """A path as a reader takes it when its characters are not to be read as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
