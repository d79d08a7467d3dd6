"""DuckDB SQL for the queries that SQL can express."""

CHAT_FORMAT = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), conv AS (
  SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY k) AS said,
         string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY k) AS text
  FROM turns GROUP BY conv_id
), one AS (
  SELECT min(conv_id) AS conv_id, n, count(*) AS copies, said, any_value(text) AS text FROM conv GROUP BY said, n
), begun AS (
  SELECT DISTINCT list_slice(said, 1, p) AS said FROM (SELECT said, unnest(range(1, n)) AS p FROM conv)
)
SELECT conv_id, 0::BIGINT AS first_turn, n AS n_turns, copies, text
FROM one ANTI JOIN begun USING (said)
"""

# The words of both tables, every window as text, and the document positions that a window covers.
DECONTAMINATE = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(lower_az(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(lower_az(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)
), place AS (
  SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, greatest(1, len(w) - size + 2))) AS i FROM doc, (SELECT DISTINCT size FROM win))
), hit AS (
  SELECT DISTINCT place.doc_id, place.i, place.size, win.item_id FROM place JOIN win ON place.size = win.size AND place.s = win.s
), span AS (
  SELECT row, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS s
  FROM (SELECT row, w, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM (SELECT row_number() OVER () AS row, w FROM item WHERE len(w) > 0))
), along AS (
  SELECT place.doc_id, span.row, place.size, place.i, place.i - span.i AS shift,
         place.i - row_number() OVER (PARTITION BY place.doc_id, span.row, place.i - span.i ORDER BY place.i) AS run
  FROM place JOIN span ON place.size = span.size AND place.s = span.s
), verbatim AS (
  SELECT doc_id, max(n) AS longest_words, min(b) FILTER (WHERE n = most) AS longest_at
  FROM (SELECT *, max(n) OVER (PARTITION BY doc_id) AS most FROM (
    SELECT doc_id, min(i) - 1 AS b, any_value(size) + count(*) - 1 AS n FROM along GROUP BY doc_id, row, shift, run)) GROUP BY doc_id
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(longest_words, 0) AS BIGINT) AS longest_words, CAST(longest_at AS BIGINT) AS longest_at
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN verbatim USING (doc_id)
""".replace(
    "lower_az(coalesce(text, ''))",
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
)

# Whole terms of both tables; integer division rounds down.
LEXICAL_SEARCH = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(lower_az(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), size AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(CAST(len(w) AS BIGINT)) AS n FROM doc WHERE len(w) > 0 GROUP BY row
), corpus AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(lower_az(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM doc) WHERE term IN (SELECT term FROM item) GROUP BY row, term
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, corpus GROUP BY term
), impact AS (
  SELECT row, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS part
  FROM held JOIN weighed USING (term) JOIN size USING (row), corpus
), total AS (
  SELECT item_id, row, CAST(sum(part) AS BIGINT) AS score FROM item JOIN impact USING (term) GROUP BY item_id, row HAVING sum(part) > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM total JOIN size USING (row) QUALIFY rank <= 50
""".replace("lower_az(text)", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

# The CRC-32 of the id's digits bit by bit; a node is the list of its turns.
CONVERSATION_TRIE = """
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT conv_id FROM turns)
  UNION ALL
  SELECT conv_id, s, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END
  FROM (SELECT conv_id, s, i, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x
        FROM crc WHERE i < 8 * length(s))
), head AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(c, CAST(4294967295 AS BIGINT)) % 6 AS h FROM crc WHERE i = 8 * length(s)
), said AS (
  SELECT head.conv_id, b.k AS place, b.r, b.t FROM head JOIN turns b ON b.conv_id = head.base AND b.k <= h
  UNION ALL
  SELECT head.conv_id, 5 + o.k, o.r, o.t FROM head JOIN turns o ON o.conv_id = head.conv_id AND o.k > h
), conv AS (
  SELECT head.conv_id, coalesce(any_value(l), []) AS l
  FROM head LEFT JOIN (SELECT conv_id, list({'r': r, 't': t} ORDER BY place) AS l FROM said GROUP BY conv_id) USING (conv_id) GROUP BY head.conv_id
), path AS (
  SELECT conv_id, len(l) AS n, d, list_slice(l, 1, d) AS p FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM conv)
), whole AS (
  SELECT conv_id, l FROM conv
), ends AS (
  SELECT l AS p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM whole GROUP BY l
), node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(p[d].t) END AS own FROM path GROUP BY p, d
), parent AS (
  SELECT c.p, c.d, c.conv_id, c.n_convs, c.own, u.conv_id AS parent_conv_id FROM node c LEFT JOIN node u ON u.d = c.d - 1 AND u.p = list_slice(c.p, 1, c.d - 1)
), kids AS (
  SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), below AS (
  SELECT list_slice(p, 1, a) AS p, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(own) AS saved
  FROM (SELECT node.p, own, n_children, unnest(range(0, d + 1)) AS a FROM node LEFT JOIN kids USING (p)) GROUP BY 1
)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM parent LEFT JOIN kids USING (p) JOIN below USING (p) LEFT JOIN ends USING (p)
"""

ORACLE_SQL = {"op1_chat_format": CHAT_FORMAT, "op4_decontaminate": DECONTAMINATE, "op11_conversation_trie": CONVERSATION_TRIE,
              "op12_lexical_search": LEXICAL_SEARCH}
