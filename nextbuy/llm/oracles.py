"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Brute force: every pair that shares a shingle, then a transitive closure of the links.
ORACLES["op10_hyperminhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words ELSE words[i:i + 4] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp c ON c.a = d.doc_id
"""

ORACLES["op1_chat_format"] = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(role || chr(0) || text, '([<\[])(\\*)(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>|\|eot_id\|>|\|start_header_id\|>|\|end_header_id\|>)', '\1\2\\\3', 'g')) - 1 + 23 AS chars FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest
"""

ORACLES["op6_quality_rules"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
t AS (SELECT doc_id, i, words[i:i + 2] AS tri FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT doc_id, tri FROM t GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM t JOIN twice USING (doc_id, tri), range(0, 3) AS r(k) GROUP BY doc_id),
q AS (
  SELECT w.doc_id, stratum, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q),
grid(rule, level, cutoff) AS (
  SELECT 'symbols', unnest(range(6)), unnest([200, 100, 50, 30, 20, 10]) UNION ALL
  SELECT 'dup_lines', unnest(range(7)), unnest([90, 80, 70, 60, 50, 40, 30]) UNION ALL
  SELECT 'repeat_words', unnest(range(6)), unnest([45, 40, 35, 30, 25, 20]) UNION ALL
  SELECT 'word_length', unnest(range(5)), unnest([3000, 2000, 1500, 1200, 1000])),
v AS (
  SELECT doc_id, stratum, base_failed, unnest(['symbols', 'dup_lines', 'repeat_words', 'word_length']) AS rule,
         unnest([n_symbols, n_dup_lines, n_repeat_words, word_chars]) AS value, unnest([n_words, n_lines, n_words, n_words]) AS base FROM b),
l AS (SELECT doc_id, min(quality) AS label FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
c AS (
  SELECT stratum, rule, level, cutoff, count(*) FILTER (label = 1) AS n, count(*) FILTER (label = 1 AND 100 * value > cutoff * base) AS good,
         count(*) FILTER (label = 0 AND 100 * value > cutoff * base) AS bad
  FROM v JOIN l USING (doc_id) JOIN grid USING (rule) WHERE NOT base_failed GROUP BY ALL),
tests AS (SELECT count(DISTINCT stratum || '/' || rule) AS m FROM c),
p AS (
  SELECT c.*, good >= 0.0125 * n OR (SELECT sum(exp(lgamma(n + 1) - (CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END) - lgamma(n - i + 1) + i * ln(0.0125) + (n - i) * ln(0.9875)))
                                     FROM range(0, good + 1) AS r(i)) > 0.05 / (SELECT m FROM tests) AS fails FROM c),
ok AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM p x WHERE x.stratum = p.stratum AND x.rule = p.rule AND x.level <= p.level AND x.fails)),
best AS (SELECT stratum, rule, arg_max(cutoff, (bad - good) * 100 - level) AS cutoff FROM ok WHERE bad > good GROUP BY ALL),
broken AS (SELECT DISTINCT doc_id FROM v JOIN best USING (stratum, rule) WHERE 100 * value > cutoff * base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM b
"""

# Every byte of every text with its 50-byte window, in hexadecimal.
ORACLES["op11_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, c0, substring(h, 2 * c0 + 1, 698) AS part FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2, 300)) AS c0 FROM d)),
w AS (
  SELECT doc_id, c0 + i AS p, substring(part, 2 * i + 1, 2) AS byte, CASE WHEN 2 * i + 100 <= strlen(part) THEN substring(part, 2 * i + 1, 100) END AS s
  FROM (SELECT doc_id, c0, part, unnest(range(least(300, strlen(part) // 2))) AS i FROM c)),
f AS (SELECT s, min(doc_id) AS low FROM w WHERE s IS NOT NULL GROUP BY s),
g AS (
  SELECT doc_id, p, byte, max(CASE WHEN low < doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM w LEFT JOIN f ON f.s = w.s),
r AS (SELECT *, gone = 1 AND lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) = 0 AS opens FROM g),
x AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(byte, '' ORDER BY p) FILTER (gone = 0) AS kept
  FROM r GROUP BY doc_id)
SELECT d.doc_id, (strlen(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN x ON x.doc_id = d.doc_id
"""

# Every phrase of one to three words of a piece, counted outright.
ORACLES["op12_collocations"] = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM w, range(1, 4) AS r(m)),
f AS (SELECT lang, m, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND c >= 10),
cuts AS (SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y FROM cand, range(1, 3) AS r(k) WHERE k < m),
s AS (SELECT cuts.*, x.c AS l, y.c AS r, ((1000000 * a::HUGEINT * a) // (x.c::HUGEINT * y.c))::BIGINT AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM s),
inner2 AS (SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, a FROM cand WHERE m = 3),
longer AS (SELECT lang, phrase, max(a) AS b FROM inner2 GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer o ON o.lang = best.lang AND o.phrase = best.phrase WHERE i = 1 AND (b IS NULL OR 100 * b < 50 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""
