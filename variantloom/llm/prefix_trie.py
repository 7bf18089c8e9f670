"""Trie of conversation prefixes: one SQL ROLLUP over positional columns of turns gives the nodes of all depths together.

A turn is named by a digest of role and text, with the text's word count behind it. A conversation becomes
blocks of ``WIDTH`` turns, one column for each position. ``GROUP BY block, k1, k2, ROLLUP (t1, ..)`` forms the nodes
of every depth of every block at once, told apart by ``grouping_id()``; a long conversation goes on in further
blocks, keyed by the node in which its prior block ended. That key, ``(k1, k2)``, is the exclusive or of two hashes of
each (position, turn) before the block. It needs no walk from block to block: partial values are combined in any
grouping, so long conversations are cut into spans of blocks like everything else.

Sums over subtrees are a second ROLLUP over the nodes. What hangs below a block's last column comes from the
blocks that go on there: their sums reach all blocks above by pointer doubling, in as many rounds as the
logarithm of the longest conversation's blocks.

Rows without a conversation id take no part. Turns go by number, null first, then by digest, so rows that repeat a
number have a fixed order and repeated rows are turns of their own. Null role or text is empty. An empty table has no
node; otherwise the root is there, even if no conversation has a turn.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from variantloom.llm.common import batches, partitions, written
from variantloom.operators.joins import splittable_join

WIDTH = 8
SPAN = 512  # blocks whose keys are summed up in one window
ID_BITS = 12  # conversations are listed in chunks of 2 ** ID_BITS ids
WORDS = r"[^\x20\x09-\x0D]+"
COLUMNS = [f"t{i}" for i in range(1, WIDTH + 1)]
NODE = ["depth", "k1", "k2"]
GROUP = ["block", "k1", "k2"]

ENDS = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])


def turn_rows(conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """``conv_id, turn, t``: ``t`` is the digest of role and text and, in its last four bytes, the text's words."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    t = F.unhex(F.concat(digest, F.lpad(F.hex(F.regexp_count(text, F.lit(WORDS))), 8, "0")))
    return conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                t.alias("t")).filter("conv_id IS NOT NULL")


def placed(rows):
    """``(turns, pieces)``: turns numbered within their piece of a conversation, and the pieces with their offsets.

    A global sort cuts long conversations into pieces, one for each range of the sort.
    """
    order = [F.asc_nulls_first("turn"), F.asc("t")]
    ranged = rows.repartitionByRange("conv_id", *order).withColumn("piece", F.spark_partition_id())
    ranged = written(ranged)
    turns = ranged.withColumn("at", F.row_number().over(Window.partitionBy("piece", "conv_id").orderBy(*order)) - 1)
    pieces = ranged.groupBy("piece", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return turns, written(pieces.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))))


def rebuild_rule(pieces, family, heads):
    """Per conversation: ``base``, ``h`` own turns that go, ``n_head`` turns of the base that come, and ``m`` turns in the end."""
    sizes = pieces.groupBy("conv_id").agg(F.sum("n").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % family
    h = F.when(F.col("conv_id") == base, 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    ruled = sizes.select("conv_id", "n", base.alias("base"), h.cast("long").alias("h"))
    bases = sizes.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    ruled = ruled.join(bases, "base", "left").withColumn("n_head", F.least("h", F.coalesce("n_base", F.lit(0))))
    return ruled.select("conv_id", "base", "h", "n_head", (F.col("n_head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("m"))


def rebuilt(turns, pieces, rule, family, heads):
    """``conv_id, place, t, m`` of every rebuilt conversation."""
    known = pieces.join(rule.select("conv_id", "h", "n_head", "m"), "conv_id")
    at = turns.join(known, ["piece", "conv_id"]).withColumn("place", F.col("offset") + F.col("at"))
    own = at.filter("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("n_head")).alias("place"), "t", "m")
    first = at.filter((F.col("conv_id") % family == 0) & (F.col("place") < heads - 1)).select(F.col("conv_id").alias("base"), "place", "t")
    lent = rule.filter("n_head > 0").join(first, "base").filter("place < n_head").select("conv_id", "place", "t", "m")
    return own.unionByName(lent)


def xored(columns):
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def place_hash(which, place, t):
    """One of two hashes of a turn at a place; zero for no turn."""
    return F.when(t.isNotNull(), F.xxhash64(F.lit(which), place, t)).otherwise(F.lit(0).cast("long"))


def blocks_of(turns):
    """Blocks of ``WIDTH`` turns, keyed by what comes before them in their conversation."""
    cut = turns.withColumn("block", F.floor(F.col("place") / WIDTH)).withColumn("slot", (F.col("place") % WIDTH).cast("int"))
    both = [F.bit_xor(place_hash(i, F.col("place"), F.col("t"))).alias(f"x{i}") for i in (1, 2)]
    blocks = written(cut.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("t"))).alias(c) for i, c in enumerate(COLUMNS)], F.max("m").alias("m"), *both)
        .withColumn("span", F.floor(F.col("block") / SPAN)))
    none = F.lit(0).cast("long")
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = blocks.groupBy("conv_id", "span").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    spans = spans.select("conv_id", "span", *[F.coalesce(F.bit_xor(f"y{i}").over(before), none).alias(f"y{i}") for i in (1, 2)])
    within = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.select("*", *[F.coalesce(F.bit_xor(f"x{i}").over(within), none).alias(f"z{i}") for i in (1, 2)])
    keyed = inside.join(spans, ["conv_id", "span"])
    return blocks, keyed.select("conv_id", "block", *COLUMNS, "m", *[F.col(f"y{i}").bitwiseXOR(F.col(f"z{i}")).alias(f"k{i}") for i in (1, 2)])


def rolled(rows, aggregates):
    """The rows' prefixes of all lengths: one ROLLUP, without groups in which a conversation had ended before."""
    columns = ", ".join(COLUMNS)
    groups = rows.sparkSession.sql(
        f"SELECT {', '.join(GROUP)}, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates} FROM {{rows}} "
        f"GROUP BY {', '.join(GROUP)}, ROLLUP ({columns})", rows=rows)
    there = sum((F.col(c).isNotNull().cast("int") for c in COLUMNS), F.lit(0))
    return groups.filter((F.col("level") > 0) & (F.col("level") == there))


def named(nodes):
    """Add ``depth``, the node's own key ``n1, n2`` and its parent's ``p1, p2``."""
    nodes = nodes.withColumn("depth", F.col("block") * WIDTH + F.col("level"))
    for i in (1, 2):
        hashes = [place_hash(i, F.col("block") * WIDTH + j, F.col(c)) for j, c in enumerate(COLUMNS)]
        last = reduce(lambda rest, j: F.when(F.col("level") == j + 1, hashes[j]).otherwise(rest), range(WIDTH), F.lit(0).cast("long"))
        nodes = nodes.withColumn(f"n{i}", xored([F.col(f"k{i}"), *hashes])).withColumn(f"p{i}", F.col(f"n{i}").bitwiseXOR(last))
    return nodes


def below(nodes):
    """Per block group after the first of a conversation: leaves and saved words in it and in all that goes on from it."""
    sums = nodes.filter("block > 0").groupBy(*GROUP).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    up = nodes.filter(f"level = {WIDTH} AND block > 0").select(
        (F.col("block") + 1).alias("block"), F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.col("k1").alias("u1"), F.col("k2").alias("u2"))
    # ``u``: the group 1, 2, 4, .. blocks above; null beyond the second block
    groups = written(sums.join(up, GROUP, "left"))
    top = groups.agg(F.max("block")).first()[0] or 0
    step = 1
    while step < top:
        reach = groups.filter("u1 IS NOT NULL")
        gained = reach.groupBy((F.col("block") - step).alias("block"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(
            F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        above = groups.select((F.col("block") + step).alias("block"), F.col("k1").alias("u1"), F.col("k2").alias("u2"),
                              F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        moved = splittable_join(groups, above, ["block", "u1", "u2"], "left").join(gained, GROUP, "left")
        groups = written(moved.select(*GROUP, *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaf", "saved")],
                                      F.col("v1").alias("u1"), F.col("v2").alias("u2")))
        step *= 2
    return groups.select(*GROUP, F.col("leaf").alias("more_leaf"), F.col("saved").alias("more_saved"))


def hashed(source):
    """Chunks sorted by node and id, as one running digest for each node."""
    def rows():
        node, running = None, None
        for batch in source:
            for *key, chunk in zip(*(batch.column(c).to_pylist() for c in (*NODE, "chunk"))):
                if key != node:
                    if node:
                        yield *node, running.hexdigest()
                    node, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(chunk.encode())
        if node:
            yield *node, running.hexdigest()

    return batches(rows(), ENDS)


def ends_of(ends):
    """``depth, k1, k2, ends_sha256``. Ids are joined in chunks in parallel; a digest runs over its node's chunks in one stream."""
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = ends.groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("part")).agg(ids.alias("chunk"))
    dealt = chunks.repartition(partitions(ends), *NODE).sortWithinPartitions(*NODE, "part")
    return dealt.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations, family=20, heads=4, **columns):
    """Nodes of the rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversation ``c`` starts with the first ``crc32(c) % heads`` turns of ``c - c % family`` instead of its own.
    """
    # stored before the sort, which reads its input twice: texts are read and digested once
    turns, pieces = placed(written(turn_rows(conversations, **columns)))
    rule = written(rebuild_rule(pieces, family, heads))
    blocks, keyed = blocks_of(rebuilt(turns, pieces, rule, family, heads))
    filled = sum((F.col(c).isNotNull().cast("long") for c in COLUMNS), F.lit(0).cast("long"))
    ends = blocks.groupBy("conv_id").agg(F.sum(filled).alias("depth"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"))
    none = F.lit(0).cast("long")
    ends = ends.unionByName(rule.filter("m = 0").select("conv_id", none.alias("depth"), none.alias("k1"), none.alias("k2")))

    last = reduce(lambda rest, c: F.coalesce(rest, c), [F.col(c) for c in reversed(COLUMNS)])
    words = F.conv(F.hex(F.substring(last, 17, 4)), 16, 10).cast("long")
    nodes = named(rolled(keyed, "min(conv_id) AS conv_id, count(*) AS n_convs, max(m) AS m"))
    nodes = written(nodes.withColumn("leaf", (F.col("m") == F.col("depth")).cast("long"))
                    .withColumn("saved", (F.col("n_convs") - 1) * words).drop("m"))
    more = below(nodes).withColumnsRenamed({"k1": "n1", "k2": "n2"})
    on = nodes.withColumn("next", F.when(F.col("level") == WIDTH, F.col("block") + 1))
    carried = on.join(more.withColumnRenamed("block", "next"), ["next", "n1", "n2"], "left")
    carried = carried.select(*GROUP, *COLUMNS, "conv_id", "n_convs",
                             *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaf", "saved")])
    # a node is the largest of its subtree and has its smallest member
    whole = written(named(rolled(carried, "min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens"))
                    .select("depth", "n1", "n2", "p1", "p2", "conv_id", "n_convs", "n_leaves", "saved_tokens"))

    everything = rule.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    top = whole.filter("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    root = top.filter(F.lit(everything["n_convs"] > 0)).select(
        F.lit(everything["conv_id"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(everything["n_convs"]).cast("long").alias("n_convs"), "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), none.alias("k1"), none.alias("k2"))

    parents = whole.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    children = whole.filter("depth > 1").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    first = whole.filter("depth = 1").withColumn("parent_conv_id", F.lit(everything["conv_id"]).cast("long"))
    later = splittable_join(whole.filter("depth > 1"), parents, ["depth", "p1", "p2"])
    placed_nodes = first.unionByName(later).withColumnsRenamed({"n1": "k1", "n2": "k2"}).join(children, NODE, "left")
    placed_nodes = placed_nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))).drop("p1", "p2")
    answer = placed_nodes.unionByName(root).join(ends_of(ends), NODE, "left")
    return answer.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
