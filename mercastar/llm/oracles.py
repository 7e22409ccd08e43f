"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from mercastar.llm.licenses import BASE, TEMPLATES

OP9_CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *,
    replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\o') AS safe_role,
    replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\o') AS safe_text,
    contains(text, '</s>') OR contains(role, '</s>') OR contains(role, ' [/INST]')
      OR contains(text, '\e') OR contains(text, '\l') OR contains(text, '\o')
      OR contains(role, '\e') OR contains(role, '\l') OR contains(role, '\o')
      OR ends_with(text || '</s', '</s>') AS conflicts
  FROM said
), lines AS (
  SELECT *, CASE WHEN conflicts THEN '[INST] ' || safe_role || ' [/INST]' || safe_text || '</s>'
                 ELSE '[INST] ' || role || ' [/INST]' || text || '</s>' END AS shown
  FROM marked
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(shown))::BIGINT AS formatted_chars,
  true AS round_trip
FROM lines GROUP BY conv_id
"""

OP1_REPEATS = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), hexed AS (
  SELECT r, doc_id, hex(b) AS h, octet_length(b) AS n FROM doc
), spot AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS m
  FROM (SELECT r, h, unnest(range(0, n - 399)) AS i FROM hexed WHERE n >= 400)
), twice AS (
  SELECT m FROM spot GROUP BY m HAVING count(*) > 1
), hit AS (
  SELECT r, i, i - row_number() OVER (PARTITION BY r ORDER BY i) AS g FROM spot JOIN twice USING (m)
), run AS (
  SELECT r, min(i) AS low, max(i) + 400 AS high FROM hit GROUP BY r, g
), marked AS (
  SELECT *, CASE WHEN low > max(high) OVER (
    PARTITION BY r ORDER BY low ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens
  FROM run
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY low) AS k FROM marked
), span AS (
  SELECT r, min(low) AS low, max(high) AS high FROM numbered GROUP BY r, k
), gap AS (
  SELECT r, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS a, low AS z FROM span
  UNION ALL
  SELECT r, max(high), NULL FROM span GROUP BY r
), kept AS (
  SELECT gap.r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(z, n) - a)), '' ORDER BY a) AS h
  FROM gap JOIN hexed USING (r) GROUP BY gap.r
), cut AS (
  SELECT r, sum(high - low) AS n_removed, count(*) AS n_spans FROM span GROUP BY r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, hexed.h))) AS kept_sha256
FROM hexed LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)
"""

OP2_JACCARD = r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), size AS (
  SELECT r, count(*) AS n FROM shingle GROUP BY r
), common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingle a JOIN shingle b USING (s) WHERE a.r <> b.r GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT r AS a, r AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT x.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN doc x ON x.r = reach.a JOIN doc y ON y.r = reach.b LEFT JOIN size ON size.r = x.r
GROUP BY x.r, x.doc_id
"""

OP4_INTERLEAVE = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc
), body AS (
  SELECT row_number() OVER () AS r, doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents
), sum32 AS (
  SELECT r, doc_id, source, length(h) // 2 + 1 AS size,
    xor(list_reduce(
      list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
      lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1]), 4294967295), 4294967295) AS text_crc32
  FROM body, step
), dealt AS (
  SELECT *, md5('20240501|' || coalesce(doc_id::VARCHAR, '')) AS m FROM sum32
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY m, doc_id)::DOUBLE - 0.5::DOUBLE)
    / count(*) OVER (PARTITION BY source) AS fraction FROM dealt
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, m, doc_id, source) - 1 AS pos, count(*) OVER () AS n FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
  (pos * 16 // n)::INTEGER AS shard,
  (pos - (pos * 16 // n * n + 15) // 16)::BIGINT AS slot,
  NULL::INTEGER AS grown_shard, source
FROM placed
"""

OP6_DECONTAMINATE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item WHERE len(w) > 0)
), spot AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc), (SELECT DISTINCT n FROM win)
  WHERE i + n - 1 <= len(w)
), hit AS (
  SELECT spot.r, spot.i, spot.n, win.item_id FROM spot JOIN win USING (n, phrase)
), word AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""


def _op11() -> str:
    """Plain rescans: every round compares every part with every entry."""
    square = "list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)"
    steps = []
    for r in range(5):
        steps.append(f"""
, assigned{r} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min(({square})::HUGEINT * 256 + e) AS near
  FROM part JOIN book{r} USING (p) GROUP BY r, p
)""")
        if r < 4:
            steps.append(f"""
, sums{r} AS (
  SELECT p, e, i, floor(sum(c) / count(*)) AS c
  FROM (SELECT p, near % 256 AS e, unnest(x) AS c, unnest(range(len(x))) AS i FROM assigned{r}) GROUP BY p, e, i
), book{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c
  FROM book{r} AS b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS c FROM sums{r} GROUP BY p, e) AS m USING (p, e)
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), part AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS x FROM kept, range(4) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x AS c FROM part WHERE r <= 256
){"".join(steps)}
, coded AS (
  SELECT r, string_agg(lower(printf('%02x', (near % 256)::INTEGER)), '' ORDER BY p) AS code, sum(near // 256)::BIGINT AS error
  FROM assigned4 GROUP BY r
), digest AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda v: v::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY p, e)) AS d
  FROM book4
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, d AS codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


OP11_VECTOR_CODES = _op11()


def _op12() -> str:
    """Every template at every place of its words, then the votes of the rarest ones."""
    posts, shapes = [], []
    for t, one in enumerate((*BASE, *TEMPLATES)):
        key = set(one.key_places)
        posts += [f"({t}, {j}, '{w}', {int(j in key)})" for j, w in enumerate(one.words)]
        shapes.append(
            f"({t}, '{one.label}', {str(t < len(BASE)).lower()}, {len(one.words)}, {len(key)}, "
            f"{one.looked_up}, {one.agreeing})"
        )
    return rf"""
WITH post(t, j, w, is_key) AS (VALUES {", ".join(posts)}
), shape(t, label, is_base, n, n_key, looked_up, agreeing) AS (VALUES {", ".join(shapes)}
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), tok AS MATERIALIZED (
  SELECT r, i, w FROM (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS i FROM doc) WHERE w IN (SELECT w FROM post)
), seen AS (
  SELECT w, count(DISTINCT r) AS df FROM tok GROUP BY w
), rare AS (
  SELECT r, t, w, row_number() OVER (PARTITION BY r, t ORDER BY df, w) AS k
  FROM (SELECT DISTINCT r, t, tok.w FROM tok JOIN post USING (w)) JOIN seen USING (w)
), met AS (
  SELECT tok.r, t, i - j AS o, count(*) AS matched, any_value(label) AS label, any_value(is_base) AS is_base, any_value(n) AS n
  FROM tok JOIN post USING (w) JOIN shape USING (t) JOIN rare USING (r, t, w)
  GROUP BY tok.r, t, i - j
  HAVING sum(is_key) = any_value(n_key) AND count(*) FILTER (k <= looked_up) >= any_value(agreeing)
), found AS (
  SELECT r, count(*) FILTER (is_base) AS n_base, min(o) FILTER (is_base) AS first_word, max(o) FILTER (is_base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(matched / n) AS score
  FROM met GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM doc LEFT JOIN found USING (r)
"""


OP12_LICENSES = _op12()


OP13_PREFIX_TRIE = """
WITH told AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g
  FROM conversations WHERE conv_id IS NOT NULL
), said AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) - 1 AS i, g, length(text) AS chars
  FROM told
), conv AS (
  SELECT conv_id, list(struct_pack(g := g, chars := chars) ORDER BY i) AS own FROM said GROUP BY conv_id
), crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc
), shared AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda b: ascii(b)::BIGINT),
    lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 6 AS h
  FROM conv, crc
), rebuilt AS (
  SELECT shared.conv_id, list_concat(coalesce(list_slice(head.own, 1, h), []), list_slice(shared.own, h + 1, len(shared.own))) AS turns
  FROM shared LEFT JOIN conv AS head ON head.conv_id = shared.base
), step AS MATERIALIZED (
  SELECT conv_id, d, md5(array_to_string(list_transform(list_slice(turns, 1, d), lambda t: t.g), ',')) AS node,
    CASE WHEN d > 0 THEN turns[d].chars ELSE 0 END AS chars, d = len(turns) AS is_end
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), node AS MATERIALIZED (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (is_end) AS n_ends, max(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM step GROUP BY d, node
), up AS (
  SELECT step.d, step.node, node.d AS below, node.n_ends = node.n_convs AS leaf, (node.n_convs - 1) * node.chars AS saved
  FROM node JOIN step ON step.conv_id = node.conv_id AND step.d <= node.d
), total AS (
  SELECT d, node, count(*) FILTER (below = d + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM up GROUP BY d, node
), parent AS (
  SELECT node.d, node.node, above.conv_id AS parent_conv_id
  FROM node JOIN step ON step.conv_id = node.conv_id AND step.d = node.d - 1
    JOIN node AS above ON above.d = step.d AND above.node = step.node
)
SELECT node.conv_id, node.d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM node JOIN total USING (d, node) LEFT JOIN parent USING (d, node)
"""

ORACLES: dict[str, str] = {
    "op1_repeats": OP1_REPEATS,
    "op2_jaccard": OP2_JACCARD,
    "op4_interleave": OP4_INTERLEAVE,
    "op6_decontaminate": OP6_DECONTAMINATE,
    "op9_chat": OP9_CHAT,
    "op11_vector_codes": OP11_VECTOR_CODES,
    "op12_licenses": OP12_LICENSES,
    "op13_prefix_trie": OP13_PREFIX_TRIE,
}
