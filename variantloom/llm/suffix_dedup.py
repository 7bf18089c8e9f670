"""Repeated-passage removal by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the corpus. Sorting
a suffix for every byte is not needed to find these strings. In every window of ``length`` bytes the least hash of the
``gram``-byte strings inside marks one place, its anchor, and equal windows have their anchors in the same place of
the window. A run of windows with one anchor is one record; its span is all bytes of those windows.

1. Anchors whose gram occurs once in the corpus are dropped: their windows cannot repeat.
2. Records with equal grams and equal spans repeat whole. One of them goes on for the others.
3. Where a gram has several different spans, the suffixes from the anchors on are sorted: each task sorts its own into
   a run, front-codes it (length of the prefix shared with the suffix before, then the rest), and the runs are
   exchanged by ranges of suffixes. In each range a loser tree merges the runs. It keeps, for every
   run's head, how much of it is known to equal the last suffix put out, so known prefixes are never
   compared again, and puts out the shared prefixes of neighbours. These bound which windows of a record can repeat;
   the windows of suffixes that share the gram are then told apart by their digests.

A gram with more than ``crowded`` different spans is not merged in one range: the digests of its windows are
counted by Spark instead, so that no group is held whole.

Texts are UTF-8 bytes; nulls are empty; texts shorter than ``length`` lose nothing by themselves. Rows that repeat an id
and a text are copies of each other, and both lose what they share. Long texts are read in pieces of bounded size.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from variantloom.llm.common import stored

LENGTH, GRAM = 400, 100
CROWDED = 4096
PIECE = 1 << 22
RANGE_ROWS, MOST_RANGES, SAMPLES = 20_000, 1 << 16, 8
MEMBERS = 2048  # whose windows are told apart at once
PLACE_BITS = 24
SEED = 400


@functools.lru_cache(maxsize=1)
def hash_table():
    """A random number for each byte, and an odd base with its inverse, modulo 2**64."""
    rng = np.random.default_rng(SEED)
    base = int(rng.integers(1 << 62)) * 4 + 5
    return rng.integers(1 << 63, size=256, dtype=np.uint64) * 2 + 1, base, pow(base, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def powers(number, count):
    out = np.full(count, number, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def scrambled(x):
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of some bytes, by sums of powers."""

    def __init__(self, data):
        table, base, inverse = hash_table()
        room = 1 << max(12, int(len(data)).bit_length())
        self.inverse = powers(inverse, room)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * powers(base, room)[:len(data)], out=self.sums[1:])

    def of(self, start, stop):
        return scrambled((self.sums[stop] - self.sums[start]) * self.inverse[start])


def window_least(values, width):
    """Least value of each ``width`` neighbours."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    to_right = np.minimum.accumulate(blocks, axis=1).ravel()
    to_left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_left[:count], to_right[width - 1:width - 1 + count])


def records(data, length, gram):
    """Arrays ``gram hash, span hash, at`` over the records of a text; see :func:`pack_at`."""
    out = []
    for first in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[first:first + PIECE + length - 1]
        hashes = Hashes(part)
        places = np.arange(len(part) - gram + 1)
        grams = hashes.of(slice(0, len(places)), slice(gram, None))
        low = np.uint64((1 << PLACE_BITS) - 1)
        anchor = (window_least(grams & ~low | places.astype(np.uint64), length - gram + 1) & low).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        widths = np.diff(np.append(starts, len(anchor))) - 1
        anchor = anchor[starts]
        before = anchor - starts
        span = hashes.of(starts, starts + widths + length) + scrambled((before << 10 | widths).astype(np.uint64))
        out.append((grams[anchor].view(np.int64), span.view(np.int64), pack_at(starts + first, before, widths)))
    return [np.concatenate(x) for x in zip(*out)] if out else None


def pack_at(start, before, width):
    """First window of a record, bytes from there to the anchor, and windows after the first, in one long."""
    return start << 20 | before << 10 | width


def unpack_at(at):
    return at >> 20, at >> 10 & 1023, at & 1023


def text_keys(docs, id_col, text_col):
    """``k1, k2, doc_id, text``; ``k2`` tells apart rows of one id with different texts."""
    text, doc_id = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.col(f"`{id_col}`").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(-(1 << 63))).alias("k1"), F.xxhash64(doc_id, text).alias("k2"), doc_id.alias("doc_id"), text.alias("text"))


def record_rows(rows, length, gram):
    schema = pa.schema([("h", pa.int64()), ("sp", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64())])

    def run(source):
        for batch in source:
            for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = records(np.frombuffer(text.as_py().encode(), np.uint8), length, gram)
                if found:
                    h, sp, at = found
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(sp), pa.array(np.full(len(h), k1, np.int64)), pa.array(np.full(len(h), k2, np.int64)), pa.array(at)], schema=schema)

    return rows.select("k1", "k2", "text").mapInArrow(merged_batches(run), "h long, sp long, k1 long, k2 long, at long")


def merged_batches(run, rows=1 << 16):
    """Puts small Arrow batches of a generator together."""
    def merged(source):
        held, count = [], 0
        for batch in run(source):
            held.append(batch)
            count += batch.num_rows
            if count >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


def shared_prefix(a, b):
    """Length of the common beginning of two byte strings."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


RUN_TYPE = "shared array<int>, rest binary, before binary, k1 array<long>, k2 array<long>, at array<long>, whole array<boolean>"
RUN_FIELDS = [("shared", pa.list_(pa.int32())), ("rest", pa.binary()), ("before", pa.binary()), ("k1", pa.list_(pa.int64())),
              ("k2", pa.list_(pa.int64())), ("at", pa.list_(pa.int64())), ("whole", pa.list_(pa.bool_()))]


def together(parts):
    """Byte strings with their sizes as one compressed string."""
    return zstandard.compress(np.array([len(p) for p in parts], "<i4").tobytes() + b"".join(parts), 3)


def apart(packed, count):
    """The ``count`` byte strings of :func:`together`."""
    data = zstandard.decompress(packed)
    ends = 4 * count + np.cumsum(np.frombuffer(data[:4 * count], "<i4"), dtype=np.int64)
    return [data[a:b] for a, b in zip([4 * count, *ends[:-1].tolist()], ends.tolist())]


def front_coded(entries):
    """Columns of a run: ``entries`` are ``(suffix, before, k1, k2, at, whole)`` in sorted order."""
    shared, rest, last = [], [], b""
    for entry in entries:
        same = shared_prefix(last, entry[0]) if shared else 0
        shared.append(same)
        rest.append(entry[0][same:])
        last = entry[0]
    before, *others = map(list, zip(*(e[1:] for e in entries)))
    return [shared, together(rest), together(before), *others]


def sorted_runs(contexts, length, gram, samples):
    """One row per run: its columns, a regular sample of the grams its suffixes begin with, and whether they are crowded.

    ``contexts``: ``text`` and ``found``, an array of ``k1, k2, at, whole, crowded``. Texts are read once for both kinds.
    """
    schema = pa.schema([*RUN_FIELDS, ("sample", pa.list_(pa.binary())), ("crowded", pa.bool_())])

    def run(source):
        def put(entries, crowded):
            entries.sort(key=lambda e: (e[0], e[2], e[4]))
            sample = [e[0][:gram] for e in entries[::max(1, len(entries) // samples)]]
            columns = [*front_coded(entries), sample, crowded]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, schema)], schema=schema)

        held = {False: [], True: []}
        for batch in source:
            for text, found in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode()
                for f in found.as_py():
                    start, before, width = unpack_at(f["at"])
                    held[f["crowded"]].append(
                        (data[start + before:start + width + length], data[start:start + before], f["k1"], f["k2"], f["at"], f["whole"]))
            for crowded, entries in held.items():
                if len(entries) >= 4 * RANGE_ROWS:
                    yield put(entries, crowded)
                    held[crowded] = []
        for crowded, entries in held.items():
            if entries:
                yield put(entries, crowded)

    return contexts.select("text", "found").mapInArrow(run, f"{RUN_TYPE}, sample array<binary>, crowded boolean")


def decoded(shared, rest):
    """Suffixes of a front-coded run."""
    last = b""
    for same, more in zip(shared, rest):
        last = last[:same] + more
        yield last


def dealt_runs(runs, splitters, gram):
    """Cut each run at the splitters: ``range`` and the columns of the piece, coded anew."""
    schema = pa.schema([("range", pa.int32()), *RUN_FIELDS])

    def run(source):
        for batch in source:
            for columns in zip(*(batch.column(i).to_pylist() for i in range(len(RUN_FIELDS)))):
                count = len(columns[0])
                suffixes = list(decoded(columns[0], apart(columns[1], count)))
                entries = list(zip(suffixes, apart(columns[2], count), *columns[3:]))
                at = np.searchsorted(splitters, np.array([s[:gram] for s in suffixes], object), side="right") if len(splitters) else np.zeros(len(suffixes), int)
                cuts = [0, *np.flatnonzero(np.diff(at)) + 1, len(entries)]
                for a, b in zip(cuts, cuts[1:]):
                    piece = [int(at[a]), *front_coded(entries[a:b])]
                    yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(piece, schema)], schema=schema)

    return runs.drop("sample", "crowded").mapInArrow(run, f"range int, {RUN_TYPE}")


def merge(runs):
    """Loser tree over front-coded runs ``(shared, rest)``: yields ``run, index, suffix, shared prefix`` in order.

    With every head goes the length of the prefix it is known to share with the last suffix put out. Of two heads the one
    that shares more is the smaller; only heads that share equally much are compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads = [decoded(*r) for r in runs]
    text = [next(h, None) for h in heads] + [None] * (size - len(runs))
    index = [0] * size
    losers = [None] * size

    def play(a, known_a, b, known_b):
        """Winner and what it shares with the last output, loser and what it shares with the winner."""
        if text[b] is None:
            return a, known_a, b, 0
        if text[a] is None:
            return b, known_b, a, 0
        if known_a > known_b:
            return a, known_a, b, known_b
        if known_b > known_a:
            return b, known_b, a, known_a
        left, right = text[a][known_a:], text[b][known_b:]
        same = known_a + shared_prefix(left, right)
        return (a, known_a, b, same) if left <= right else (b, known_b, a, same)

    def begin(node):
        if node >= size:
            return node - size, 0
        a, b = begin(2 * node), begin(2 * node + 1)
        winner, known, *losers[node] = play(*a, *b)
        return winner, known

    best, known = begin(1)
    while text[best] is not None:
        yield best, index[best], text[best], known
        text[best] = next(heads[best], None)
        index[best] += 1
        known = runs[best][0][index[best]] if text[best] is not None else 0
        node = (best + size) // 2
        while node:
            best, known, *losers[node] = play(best, known, *losers[node])
            node //= 2


def repeated_windows(length, gram):
    """Function of one range's pieces: intervals that repeat, of records that do not repeat whole."""
    def found(pieces):
        names = [name for name, _ in RUN_FIELDS]
        runs = [dict(zip(names, row)) for row in pieces[names].itertuples(index=False)]
        for r in runs:
            r["rest"], r["before"] = apart(r["rest"], len(r["shared"])), apart(r["before"], len(r["shared"]))
        out, group, members = [], [], []

        def close():
            if len(group) > 1:
                longest = [max(group[i][1], group[i + 1][1] if i + 1 < len(group) else 0) for i in range(len(group))]
                longest[0] = group[1][1]
                number = members[-1][0] + 1 if members else 0
                members.extend((number, text, run, i, reach) for (text, _, run, i), reach in zip(group, longest))
            group.clear()
            if len(members) >= MEMBERS:
                tell()

        def tell():
            if members:
                out.append(told_apart(members, length))
                members.clear()

        for run, i, text, known in merge([(r["shared"], r["rest"]) for r in runs]):
            if known < gram:
                close()
            group.append((text, known, runs[run], i))
        close()
        tell()
        return pd.concat(out) if out else pd.DataFrame({"k1": [], "k2": [], "start": [], "stop": []}, dtype=np.int64)

    return found


def spread_out(counts):
    """0, 1, ... up to each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def told_apart(members, length):
    """Intervals of windows that another member of the same group has too.

    ``members``: ``(group, suffix, run, index, longest prefix shared with another member)``.
    """
    groups = np.array([m[0] for m in members])
    texts = [m[2]["before"][m[3]] + m[1] for m in members]
    at = np.array([m[2]["at"][m[3]] for m in members], np.int64)
    start, before, width = unpack_at(at)
    reach = np.array([m[4] for m in members])
    # a window with more of its bytes before the anchor needs less of the suffix
    windows = np.clip(np.minimum(width, before - length + np.minimum(reach, length)) + 1, 0, None)
    hashes = Hashes(np.frombuffer(b"".join(texts), np.uint8))
    first = np.cumsum([0, *map(len, texts)])[:-1]
    member = np.repeat(np.arange(len(members)), windows)
    offset = spread_out(windows)
    place = first[member] + offset
    digest = hashes.of(place, place + length) + scrambled(groups[member].astype(np.uint64))
    _, which, times = np.unique(digest, return_inverse=True, return_counts=True)
    whole = np.array([m[2]["whole"][m[3]] for m in members], bool)
    keep = (times[which] > 1) & ~whole[member]
    member, offset = member[keep], offset[keep]
    begins = np.flatnonzero(np.concatenate(([True], (np.diff(member) != 0) | (np.diff(offset) != 1)))) if len(member) else np.array([], int)
    ends = np.append(begins[1:], len(member)) - 1 if len(member) else begins
    who = member[begins]
    return pd.DataFrame({"k1": [members[i][2]["k1"][members[i][3]] for i in who], "k2": [members[i][2]["k2"][members[i][3]] for i in who],
                         "start": start[who] + offset[begins], "stop": start[who] + offset[ends] + length}).astype(np.int64)


def counted_windows(runs, length):
    """Intervals of crowded grams: digests of all windows of their suffixes, counted by Spark."""
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64())])

    def run(source):
        for batch in source:
            for shared, rest, before, k1s, k2s, ats, _ in zip(*(batch.column(i).to_pylist() for i in range(len(RUN_FIELDS)))):
                count = len(shared)
                for suffix, head, k1, k2, at in zip(decoded(shared, apart(rest, count)), apart(before, count), k1s, k2s, ats):
                    start, _, width = unpack_at(at)
                    part = np.frombuffer(head + suffix, np.uint8)
                    places = np.arange(width + 1)
                    d1 = Hashes(part).of(places, places + length).view(np.int64)
                    d2 = Hashes(part[::-1]).of(width - places, width - places + length).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), pa.array(np.full(width + 1, k1, np.int64)),
                                                      pa.array(np.full(width + 1, k2, np.int64)), pa.array(places + start)], schema=schema)

    rows = runs.drop("sample", "crowded").mapInArrow(merged_batches(run), "d1 long, d2 long, k1 long, k2 long, start long")
    twice = rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return rows.join(twice, ["d1", "d2"]).select("k1", "k2", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(rows, length=LENGTH, gram=GRAM, crowded=CROWDED):
    """``k1, k2, spans`` of rows with repeats: byte intervals ``start, stop``, which may overlap.

    ``rows``: of :func:`text_keys`.
    """
    anchors = record_rows(rows, length, gram)
    # stored, so that both sides of the join come from exchanges and a gram with very many records is split
    again = stored(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"))
    anchors = stored(anchors.join(again, "h"))
    record = F.struct("k1", "k2", "at")
    spans = stored(anchors.groupBy("h", "sp").agg(F.count(F.lit(1)).alias("n"), F.min(record).alias("one")))
    # of the records that are left, those whose span occurs once do not repeat whole; all others do
    ats = lambda df: df.groupBy("k1", "k2").agg(F.collect_set("at").alias("ats"))
    single = ats(spans.filter("n = 1").select("one.*")).withColumnRenamed("ats", "single")
    whole = ats(anchors).join(single, ["k1", "k2"], "left").select("k1", "k2", F.explode(
        F.array_except("ats", F.coalesce("single", F.array().cast("array<long>")))).alias("at"))
    start, width = F.shiftright("at", 20), F.col("at").bitwiseAND(F.lit(1023))
    sure = whole.select("k1", "k2", start.alias("start"), (start + width + length).alias("stop"))
    several = spans.groupBy("h").agg(F.count(F.lit(1)).alias("spans")).filter("spans > 1")
    open_records = stored(spans.join(several, "h").select(
        "one.k1", "one.k2", "one.at", (F.col("n") > 1).alias("whole"), (F.col("spans") > crowded).alias("crowded")))

    found = open_records.groupBy("k1", "k2").agg(F.collect_list(F.struct("k1", "k2", "at", "whole", "crowded")).alias("found"))
    runs = stored(sorted_runs(rows.select("k1", "k2", "text").join(found, ["k1", "k2"]), length, gram, SAMPLES))
    sizes = {r["crowded"]: r["n"] for r in open_records.groupBy("crowded").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [sure]
    if sizes.get(False):
        sparse = runs.filter("NOT crowded")
        ranges = int(min(MOST_RANGES, max(1, sizes[False] // RANGE_ROWS, min(64, sizes[False] // 500))))
        # the sample is bounded by the number of ranges, and so are the splitters
        sample = sparse.select(F.explode("sample").alias("s")).orderBy(F.xxhash64("s")).limit(SAMPLES * ranges).collect()
        sample = sorted({bytes(r["s"]) for r in sample})
        splitters = np.empty(min(ranges - 1, max(0, len(sample) - 1)), object)
        splitters[:] = [sample[(i + 1) * len(sample) // (len(splitters) + 1)] for i in range(len(splitters))]
        pieces = dealt_runs(sparse, splitters, gram)
        parts.append(pieces.groupBy("range").applyInPandas(repeated_windows(length, gram), "k1 long, k2 long, start long, stop long"))
    if sizes.get(True):
        parts.append(counted_windows(runs.filter("crowded"), length))
    intervals = functools.reduce(lambda a, b: a.unionByName(b), parts)
    return intervals.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without_repeats(docs, length=LENGTH, gram=GRAM, crowded=CROWDED, id_col="doc_id", text_col="text"):
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every row."""
    rows = text_keys(docs, id_col, text_col)
    spans = repeated_spans(rows, length, gram, crowded)
    joined = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(source):
        for batch in source:
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                kept, removed, runs, at = [], 0, 0, 0
                for start, stop in sorted((s["start"], s["stop"]) for s in spans.as_py() or ()):
                    if stop <= at and runs:
                        continue
                    if start > at or not runs:
                        kept.append(data[at:start])
                        runs += 1
                        at = start
                    removed += stop - at
                    at = stop
                kept.append(data[at:])
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((doc_id, len(data), removed, runs, b"".join(kept)), schema)], schema=schema)

    return joined.mapInArrow(merged_batches(run, 256), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def cut_repeats(docs, length=LENGTH, gram=GRAM, crowded=CROWDED, id_col="doc_id", text_col="text"):
    """``docs`` with the repeated bytes cut out of ``text_col``; all columns stay.

    Where a cut goes through a character, what is left of the character goes too. Null texts stay null.
    """
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    text, doc_id = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.col(f"`{id_col}`").cast("long")
    whole = kept.select("row", F.coalesce(doc_id, F.lit(-(1 << 63))).alias("k1"), F.xxhash64(doc_id, text).alias("k2"))
    spans = repeated_spans(text_keys(docs, id_col, text_col), length, gram, crowded)
    # columns by place: any name may be in ``docs``
    joined = whole.join(spans, ["k1", "k2"], "left").select(*[F.col("row")[c].alias(f"c{i}") for i, c in enumerate(docs.columns)], "spans")
    at, schema = docs.columns.index(text_col), docs.schema

    def run(source):
        for batch in source:
            texts = []
            for text, spans in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                text, data, out, end = text.as_py(), None, [], 0
                if text is None or not spans.as_py():
                    texts.append(text)
                    continue
                data = text.encode()
                for start, stop in sorted((s["start"], s["stop"]) for s in spans.as_py()):
                    out.append(data[end:start] if start > end else b"")
                    end = max(end, stop)
                out.append(data[end:])
                texts.append(b"".join(out).decode("utf-8", "ignore"))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)
