"""op11: nodes equal a plain dictionary of prefixes; long conversations, ties and edges of the input."""

import hashlib
import random
import re
import zlib

from variantloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def named(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, named(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        base = c - int(c - 20 * int(c / 20))  # the remainder has the sign of c
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns if c == base else own.get(base, [])[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    words = re.compile(r"[^\x20\x09-\x0D]+")
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[b] for b in below) or 1
        saved[path] = sum(saved[b] for b in below) + ((len(members[path]) - 1) * len(words.findall(path[-1][1])) if path else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def result(spark, rows, schema=SCHEMA):
    table = spark.createDataFrame(rows, schema).repartition(3)
    found = prefix_trie.trie(table).collect()
    assert found == [] or found[0].__fields__ == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None and i == 2 else x for i, x in enumerate(row)) for row in found)


def test_short_and_long_conversations(spark):
    rng = random.Random(4)
    rows = []
    for c in range(-25, 70):
        stem = rng.choice(["a", "b", "c"])
        for turn in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 30])):
            text = f"{stem} {turn}" if rng.random() < 0.93 else f"odd {rng.random()}"
            rows.append((c, turn, "user" if turn % 2 else "assistant", text))
    # two that agree for 60 turns, and one that ends inside them
    for c, size in ((1000, 61), (1020, 65), (1040, 33), (1060, 64)):
        rows += [(c, t, "user", f"long {t}" + (" end" if (c, t) == (1000, 60) else "")) for t in range(size)]
    assert result(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "", "x y z"), (1, None, "user", "b"),
            (2, 0, "user", "a"), (None, 0, "user", "lost"), (20, 0, "u", " \t"), (21, 5, None, "only"), (22, 1, "u", "one"), (23, 1, "u", "one"),
            (-7, 1, "x", "neg"), (0, 1, "x", "zero"), (0, 1, "x", "zero")]
    assert result(spark, rows) == brute(rows)


def test_a_conversation_without_turns_is_in_the_root(spark):
    # no base conversation and fewer own turns than are replaced
    c = next(c for c in range(101, 120) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert result(spark, [(c, 0, "user", "gone")]) == brute([(c, 0, "user", "gone")]) == [
        (c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_many_copies_and_ids_far_apart(spark):
    rows = [(c * 3001, t, "user", f"same {t}") for c in range(40) for t in range(3)] + [(1 << 60, 0, "user", "same 0"), (-(1 << 60), 0, "user", "same 0")]
    assert result(spark, rows) == brute(rows)


def test_empty_table_and_very_long_text(spark):
    assert result(spark, []) == []
    rows = [(0, 0, "user", "word " * 200_000), (20, 0, "user", "word " * 200_000), (40, 0, "user", "é" * 500_000)]
    assert result(spark, rows) == brute(rows)


def test_clashing_columns_do_not_matter(spark):
    rows = [(c, t, "user", f"x {t}") for c in range(4) for t in range(3)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS k1", "3 AS t1", "4 AS block", "5 AS piece")
    found = prefix_trie.trie(table).collect()
    assert sorted(tuple(-1 if x is None else x for x in row) for row in found) == brute(rows)
