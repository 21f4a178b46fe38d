"""DuckDB SQL of the queries of this subpackage that SQL can express.

Each computes its result in another way than the operator: levels of a tree by a recursive
aggregate, phrases, windows and shingles as rows of text, links by counting shared shingles, sizes of
formatted conversations by running sums.
"""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

#: A tree's layers: every node with its digest, and what its run holds before and after it.
_LAYERS = """
{name} AS (
  SELECT g, i, h, 0 AS level, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL
  SELECT g, i // 16, sha256(string_agg(h, '' ORDER BY i)), level + 1, any_value((n + 15) // 16)
  FROM {name} WHERE n > 1 GROUP BY g, i // 16, level),
{name}_path AS (
  SELECT a.g, a.i, a.level,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM {name} a JOIN {name} b ON a.g = b.g AND a.level = b.level AND a.i // 16 = b.i // 16
  WHERE a.n > 1 GROUP BY a.g, a.i, a.level)"""

MERKLE = f"""
WITH RECURSIVE
bits AS (SELECT range AS i, range AS v, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1
  FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS no, *
  FROM (SELECT *, {_LEAF.format('text')} AS leaf,
          CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(
                      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 5 = 0
               THEN {_LEAF.format(LOWER.format('text'))} END AS tampered
        FROM documents, crc)),
leaves AS (SELECT coalesce('s' || source, '') AS g, leaf AS h, no,
             row_number() OVER (PARTITION BY source ORDER BY no) - 1 AS i FROM docs),
{_LAYERS.format(name='tree', leaves='(SELECT g, i, h FROM leaves)')},
subroots AS (SELECT g AS source, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM tree WHERE n = 1),
{_LAYERS.format(name='top', leaves="(SELECT '' AS g, i, h FROM subroots)")},
steps AS (
  SELECT l.no, p.level, p.before, p.after FROM leaves l
  JOIN tree_path p ON p.g = l.g AND p.i = l.i // CAST(16 ** p.level AS BIGINT)
  UNION ALL
  SELECT l.no, 1000 + p.level, p.before, p.after FROM leaves l JOIN subroots s ON s.source = l.g
  JOIN top_path p ON p.i = s.i // CAST(16 ** p.level AS BIGINT)),
proofs AS (SELECT no, list(struct_pack(b := before, a := after) ORDER BY level) AS p FROM steps GROUP BY no),
fold AS (
  SELECT d.no, coalesce(d.tampered, d.leaf) AS h, coalesce(p.p, []) AS p, 1 AS k
  FROM docs d LEFT JOIN proofs p ON p.no = d.no
  UNION ALL SELECT no, sha256(p[k].b || h || p[k].a), p, k + 1 FROM fold WHERE k <= len(p))
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root,
  sha256(coalesce(list_aggregate(list_transform(f.p, lambda x: x.b || x.a), 'string_agg', ''), '')) AS proof_sha256,
  f.h AS folded_root, f.h = r.h AS verified
FROM docs d JOIN leaves l USING (no) JOIN subroots s ON s.source = l.g
JOIN fold f ON f.no = d.no AND f.k = len(f.p) + 1 CROSS JOIN (SELECT h FROM top WHERE n = 1) r
"""

PHRASES = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^ \\t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
          unnest(regexp_split_to_array({LOWER.format('text')}, '[.,;:!?\\n\\x0B\\f\\r]')) AS p
        FROM documents WHERE text IS NOT NULL)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f AS (SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM places CROSS JOIN range(1, 5) t(m) WHERE i + m - 1 <= len(w))
      GROUP BY lang, m, phrase HAVING count(*) >= 30),
split AS (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM f),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
         (CAST(c.f AS HUGEINT) * 2000000) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM split WHERE m > 1) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f o WHERE o.lang = b.lang AND 100 * o.f >= 80 * b.a
      AND len(o.phrase) > len(b.phrase) AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

JACCARD = f"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER.format('text')}, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w
          FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT doc_id AS src, doc_id AS dst FROM documents
            UNION SELECT r.src, e.y FROM reached r JOIN edges e ON e.x = r.dst)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes z USING (doc_id)
JOIN (SELECT src AS doc_id, min(dst) AS component_id FROM reached GROUP BY src) c USING (doc_id)
"""

WINDOWS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS no, doc_id,
         regexp_extract_all(coalesce({LOWER.format('text')}, ''), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
bench AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(coalesce({LOWER.format('text')}, ''), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT item, w, least(10, len(w)) AS m, unnest(range(1, greatest(2, len(w) - 8))) AS i
        FROM bench WHERE len(w) > 0)),
places AS (
  SELECT no, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT no, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM docs JOIN (SELECT DISTINCT m FROM windows) ON len(w) >= m)),
hits AS (SELECT no, i, m, item FROM places JOIN windows USING (m, s)),
words AS (SELECT no, count(DISTINCT p) AS n_hit
          FROM (SELECT no, unnest(range(i, i + m)) AS p FROM hits) GROUP BY no),
items AS (SELECT no, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS ids
          FROM (SELECT DISTINCT no, item FROM hits) GROUP BY no)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (no) LEFT JOIN items USING (no)
"""

_ESCAPED = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"

CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
sized AS (
  SELECT *, role = 'assistant' AS reply, sum(
      length('<|im_start|><|im_end|>') + 2 + length(replace({_ESCAPED.format('role')}, chr(10), '..'))
      + length({_ESCAPED.format('text')})) OVER (PARTITION BY conv_id ORDER BY i) AS upto
  FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (reply), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (reply OR i = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (reply OR i = n) AS n_examples
FROM sized GROUP BY conv_id
"""

ORACLES = {"op2_decontamination": WINDOWS, "op7_chat_formatting": CHAT,
           "op11_merkle_manifest": MERKLE, "op12_phrase_collocations": PHRASES,
           "op13_jaccard_join": JACCARD}
