"""DuckDB SQL for the subpackage's queries that SQL can express on whole tables."""

from __future__ import annotations

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PHRASES = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({doc_text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({item_text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[s:s + 9] AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(gram) AS n FROM windows),
grams AS (
  SELECT doc_id, s, n, w[s:s + n - 1] AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM words, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, s, n FROM grams JOIN windows USING (gram)),
hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""".format(doc_text=_ASCII_LOWER.format("text"), item_text=_ASCII_LOWER.format("text"))

_LINKS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda s: hash(w[s:s + 4])))) AS g
  FROM words WHERE len(w) > 0),
classes AS (SELECT min(doc_id) AS rep, g FROM sets GROUP BY g),
tokens AS (SELECT rep, len(g) AS n, unnest(g) AS t FROM classes),
pairs AS (
  SELECT a.rep AS x, b.rep AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach(x, y) AS (SELECT rep, rep FROM classes UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(len(s.g), 0) AS BIGINT) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM words d LEFT JOIN sets s USING (doc_id) LEFT JOIN classes c ON s.g = c.g LEFT JOIN least_of l ON l.x = c.rep
""".format(text=_ASCII_LOWER.format("text"))

#: crc32 of a byte list, by a table of 256 remainders computed here.
_CRC = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM range(256) r(i))
"""

_VARIANTS = rf"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({_ASCII_LOWER.format("text")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
bytes AS (
  SELECT run, k, list_transform(range(0, len(h) // 2), lambda j: CAST('0x' || substr(h, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT)) AS b
  FROM (SELECT run, k, hex(encode(doc_id || ':' || run)) AS h FROM runs)),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) AS h FROM bytes, crc_table),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n
  FROM (SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole FROM places),
less AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
indels AS (SELECT l.word AS longer, l.n AS longer_n, w.word AS shorter, w.n AS shorter_n FROM less l JOIN words w ON l.rest = w.word),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT longer, shorter, shorter_n FROM indels
  UNION ALL SELECT shorter, longer, longer_n FROM indels),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS best, max(other_n) AS best_n FROM near GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
    CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk(word, reached, hops) AS (
  SELECT word, form, 1 FROM judged WHERE form IS NOT NULL
  UNION ALL SELECT w.word, j.form, w.hops + 1 FROM walk w JOIN judged j ON w.reached = j.word WHERE j.form IS NOT NULL),
roots AS (SELECT word, arg_max(reached, hops) AS root FROM walk GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM judged LEFT JOIN roots USING (word)
"""

_REPEATS = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20)),
late AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM late),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_MIDDLES = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
numbers AS (
  SELECT *, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS h4 FROM drawn),
formed AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
      WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM formed
"""

ORACLE: dict[str, str] = {
    "op4_phrase_index": _PHRASES,
    "op8_adaptive_join": _LINKS,
    "op11_permuterm": _VARIANTS,
    "op12_fm_index": _REPEATS,
    "op13_block_rotation": _MIDDLES,
}
