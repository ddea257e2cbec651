"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# A-Z become a-z; a word is a run of ASCII letters, digits and characters beyond ASCII.
_WORDS = """list_filter(regexp_split_to_array(
    translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""

_WINDOWS = """SELECT {id} AS id, i, array_to_string(w[i:least(i + {n} - 1, len(w))], ' ') AS s
    FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - {n} + 1, least(len(w), 1)) + 1)) AS i
          FROM (SELECT {id}, {words} AS w FROM {table}))"""

# Ids that can be reached over links, for every id of links(a, b), in both directions.
_REACH = """reach AS (SELECT DISTINCT a, a AS b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)"""

OP2 = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
told AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<|im_start|>') + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + 1
        + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1) AS formatted_chars
    FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM told
"""

OP3 = f"""
WITH RECURSIVE shingles AS (SELECT DISTINCT id, s FROM ({_WINDOWS.format(id="doc_id", n=5, words=_WORDS.format(text="text"), table="documents")})),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
links AS (SELECT p.a, p.b FROM (SELECT x.id AS a, y.id AS b, count(*) AS shared
              FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY 1, 2) p
          JOIN sizes u ON u.id = p.a JOIN sizes v ON v.id = p.b WHERE 5 * shared >= 4 * (u.n + v.n - shared)),
{_REACH},
classes AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN classes ON classes.a = doc_id LEFT JOIN counts ON counts.a = doc_id
"""

OP5 = f"""
WITH windows AS ({_WINDOWS.format(id="item_id", n=13, words=_WORDS.format(text="text"), table="benchmark")}),
patterns AS (SELECT DISTINCT id AS item_id, s, len(string_split(s, ' ')) AS n FROM windows),
docs AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
places AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                 FROM docs, (SELECT DISTINCT n FROM patterns))),
found AS (SELECT doc_id, i, places.n, item_id FROM places JOIN patterns ON places.s = patterns.s AND places.n = patterns.n),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
largest AS (SELECT payload, max(page_id) AS response FROM payloads WHERE octet_length(payload) >= 1000 GROUP BY payload)
SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM payloads LEFT JOIN largest USING (payload)
"""

OP7 = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
          ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
          WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) >= 0.98),
{_REACH},
classes AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN classes ON classes.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""

# The CRC of a short ASCII text, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, y: xor(b >> 1, (b & 1) * 3988292384))), 4294967295)"""
OP11 = rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, role, sha256(CAST(octet_length(encode(role)) AS VARCHAR) || ':' || role || text) AS key,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens FROM turns),
own AS (SELECT conv_id, list({{'key': key, 'tokens': tokens}} ORDER BY turn NULLS FIRST, role, key) AS t,
    {_CRC32.format(text="CAST(conv_id AS VARCHAR)")} % 4 AS h FROM keyed GROUP BY conv_id),
rebuilt AS (SELECT own.conv_id, list_concat(list_slice(coalesce(base.t, []), 1, own.h), list_slice(own.t, own.h + 1, len(own.t))) AS t
    FROM own LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 20),
prefixes AS (SELECT conv_id, d, array_to_string(list_transform(list_slice(t, 1, d), lambda x: x.key), '') AS p,
    array_to_string(list_transform(list_slice(t, 1, d - 1), lambda x: x.key), '') AS up, CASE WHEN d > 0 THEN t[d].tokens ELSE 0 END AS tokens,
    len(t) = d AS ends FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT p, any_value(CASE WHEN d > 0 THEN up END) AS up, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(tokens) AS tokens,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY p, d),
children AS (SELECT up, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
above AS (SELECT n.p, left(n.p, CAST(64 * i AS BIGINT)) AS a FROM nodes n, unnest(range(0, n.d + 1)) AS x(i)),
below AS (SELECT above.a, count(*) FILTER (WHERE children.n IS NULL) AS n_leaves, sum((nodes.n_convs - 1) * nodes.tokens) AS saved
    FROM above JOIN nodes ON nodes.p = above.p LEFT JOIN children ON children.up = above.p GROUP BY above.a)
SELECT nodes.conv_id, nodes.d AS depth, parent.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
    below.n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes LEFT JOIN nodes parent ON parent.p = nodes.up LEFT JOIN children ON children.up = nodes.p JOIN below ON below.a = nodes.p
"""

# Vectors of integers, the first centroids, and three rounds of assignment and exact floors of means.
_NEAREST = """a{i} AS MATERIALIZED (SELECT v.vec_id, v.v, arg_min(c.k, (list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.k)) AS k
    FROM vectors v, c{i} c GROUP BY v.rowid, v.vec_id, v.v)"""
_MEANS = """c{j} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c FROM (
        SELECT k, d, CAST(sum(v[d]) AS BIGINT) AS s, count(*) AS n FROM (SELECT k, v, unnest(range(1, 65)) AS d FROM a{i}) GROUP BY k, d)
    GROUP BY k) m ON m.k = c.k)"""
OP13 = f"""
WITH vectors AS MATERIALIZED (SELECT row_number() OVER () AS rowid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c
    FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM vectors ORDER BY h LIMIT 16)),
{", ".join(f"{_NEAREST.format(i=i)}, {_MEANS.format(i=i, j=i + 1)}" for i in range(3))},
{_NEAREST.format(i=3)},
found AS (SELECT vec_id, a3.k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance, c
          FROM a3 JOIN c3 ON c3.k = a3.k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found
"""

ORACLES = {
    "op2_chat_formatting": OP2,
    "op3_ngram_jaccard_join": OP3,
    "op5_benchmark_decontamination": OP5,
    "op6_warc": OP6,
    "op7_embedding_near_dedup": OP7,
    "op11_prefix_trie": OP11,
    "op13_centroid_clustering": OP13,
}
