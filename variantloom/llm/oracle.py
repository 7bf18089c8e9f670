"""SQL counterparts of the corpus queries, where SQL can express them."""

from __future__ import annotations

from variantloom.llm import licenses

TOPK = """
WITH quantized AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM quantized q, quantized c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored) WHERE r <= 5
"""

EMBED_DEDUP = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a, vectors b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
), components AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

# Lines by document and place; near ones by brute force over all lines of similar length.
LINE_DEDUP = """
WITH RECURSIVE docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM docs
), known AS (
  SELECT line, row_number() OVER (ORDER BY line) AS id, count(*) AS n FROM lines WHERE regexp_matches(line, '\\S') GROUP BY line
), long_lines AS (SELECT id, line, length(line) AS size FROM known WHERE length(line) >= 30),
links AS (
  SELECT a.id AS a, b.id AS b FROM long_lines a JOIN long_lines b ON b.size BETWEEN a.size - 1 AND a.size + 1
  WHERE a.id <> b.id AND (left(a.line, a.size // 2) = left(b.line, a.size // 2)
    OR right(a.line, a.size - a.size // 2 - 1) = right(b.line, a.size - a.size // 2 - 1)) AND levenshtein(a.line, b.line) <= 1
), reach(id, other) AS (
  SELECT id, id FROM known UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
), classes AS (SELECT id, min(other) AS class FROM reach GROUP BY id),
placed AS (
  SELECT l.doc_id, l.place, l.line, row_number() OVER (PARTITION BY c.class ORDER BY l.doc_id, l.place) AS nth
  FROM lines l JOIN known k ON l.line = k.line JOIN classes c ON k.id = c.id
), marked AS (
  SELECT lines.doc_id, lines.place, lines.line, coalesce(nth > 1, false) AS gone
  FROM lines LEFT JOIN placed ON lines.doc_id = placed.doc_id AND lines.place = placed.place
), texts AS (
  SELECT doc_id, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_lines_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines_removed, 0) AS n_lines_removed,
       CAST(CASE WHEN d.text IS NOT NULL THEN length(coalesce(kept, '')) END AS BIGINT) AS n_chars_kept,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d LEFT JOIN texts USING (doc_id)
"""

# Conversations as lists; every list prefix is a node, and a subtree is met by comparing prefixes.
PREFIX_TRIE = """
WITH named AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT conv_id, list(struct_pack(role := role, text := text)
           ORDER BY turn NULLS FIRST, md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS own FROM named GROUP BY conv_id
), ruled AS (
  SELECT c.conv_id, c.own, b.own AS base, CASE WHEN c.conv_id % 20 = 0 THEN 0 ELSE
    xor(list_reduce(list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
      lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
      4294967295), 4294967295) % 4 END AS h
  FROM lists c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20
), rebuilt AS (
  SELECT conv_id, list_concat(coalesce(base[1:h], []), own[h + 1:]) AS turns FROM ruled
), members AS (
  SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS at_end FROM rebuilt, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(at_end) AS leaf,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[d].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM members GROUP BY path, d
)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, min(p.conv_id) AS parent_conv_id, CAST(a.n_convs AS BIGINT) AS n_convs,
  CAST(count(*) FILTER (WHERE b.d = a.d + 1) AS BIGINT) AS n_children, CAST(count(*) FILTER (WHERE b.leaf) AS BIGINT) AS n_leaves,
  CAST(sum(b.saved) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM nodes a JOIN nodes b ON b.path[1:a.d] = a.path AND b.d >= a.d LEFT JOIN nodes p ON p.d = a.d - 1 AND p.path = a.path[1:a.d - 1]
GROUP BY a.conv_id, a.d, a.n_convs, a.ends_sha256
"""


def license_sql():
    """Every phrase compared at every word of every document."""
    def listed(words):
        return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"

    def at(phrase):
        places = f"[i for i in range(len(w)) if w[i + 1:i + {len(phrase.words)}] = {listed(phrase.words)}]"
        return f"CASE WHEN list_has_all(w, {listed(phrase.words)}) THEN {places} ELSE [] END"

    known = licenses.templates()
    columns, shares = [], []
    for n, t in enumerate(known):
        first = t.keys[0]
        others = "".join(
            f" AND len([q for q in {at(k)} if abs(q - {k.offset} - s) <= {licenses.SLACK}]) > 0" for k in t.keys[1:])
        columns.append(f"[s for s in [p - {first.offset} for p in {at(first)}] if true{others}] AS s{n}")
        near = (f"list_contains(w[greatest(1, s + j - {licenses.SLACK} + 1):greatest(0, s + j + {licenses.SLACK} + 1)], {listed(t.words)}[j + 1])")
        shares.append(f"[CAST(len([j for j in range({len(t.words)}) if {near}]) AS DOUBLE) / {len(t.words)} for s in s{n}] AS c{n}")
    base = [n for n, t in enumerate(known) if t.is_base]
    starts = "flatten([" + ", ".join(f"s{n}" for n in base) + "])"

    def labels(of):
        one = ", ".join(f"CASE WHEN len([c for c in c{n} if c >= {licenses.COVERAGE}]) > 0 THEN '{known[n].label}' END" for n in of)
        return f"coalesce(array_to_string(list_sort(list_distinct([x for x in [{one}] if x IS NOT NULL])), ','), '')"

    every = "flatten([" + ", ".join(f"c{n}" for n in range(len(known))) + "])"
    # phrases are looked for where all their words are, else the list of places is empty at once
    return f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), placed AS (SELECT doc_id, w, {", ".join(columns)} FROM texts
), shared AS (SELECT *, {", ".join(shares)} FROM placed)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len({starts}) AS BIGINT) AS n_base,
  CAST(list_min({starts}) AS BIGINT) AS first_word, CAST(list_max({starts}) AS BIGINT) AS last_word,
  {labels(base)} AS base_labels, {labels(range(len(known)))} AS labels,
  coalesce(list_max([c for c in {every} if c >= {licenses.COVERAGE}]), CAST(0 AS DOUBLE)) AS score
FROM shared
"""


def centroid_sql(rounds=3, clusters=16):
    """Full scans: every round is one relation of distances and one of means."""
    distance = "list_sum([power(p.v[i] - c.v[i], 2) for i in range(1, 65)])::BIGINT"
    parts = [f"""
vectors AS MATERIALIZED (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE))::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v
  FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM vectors WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {clusters})
)"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, v, min(struct_pack(d := d, k := k)) AS best
  FROM (SELECT p.vec_id, p.v, c.k, {distance} AS d FROM vectors p, c{r} c) GROUP BY vec_id, v
)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (
  SELECT best.k AS k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY best.k, i
), c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY k) m ON c.k = m.k
)""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON a{rounds}.best.k = c{rounds}.k
"""


def oracle_sql():
    return {"op11_prefix_trie": PREFIX_TRIE, "op12_licenses": license_sql(), "op13_centroids": centroid_sql(), "op10_line_dedup": LINE_DEDUP, "op2_embed_dedup": EMBED_DEDUP, "op4_topk": TOPK}
