"""SQL for DuckDB of the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SOLID = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATION = f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER.format('text')}, {_WORD}) AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, {_WORD}) AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS win
  FROM items WHERE len(w) > 0),
places AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM texts, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (SELECT r, p, s.n, item_id FROM places s JOIN windows i ON i.n = s.n AND s.w[s.p:s.p + s.n - 1] = i.win),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY 1),
owners AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN words USING (r) LEFT JOIN owners USING (r)
"""

QUALITY_RULES = f"""
WITH texts AS (
  SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SOLID}) AS w FROM documents),
places AS (SELECT r, unnest(range(1, len(w) - 3)) AS p, w FROM texts WHERE len(w) > 4),
twice AS (SELECT r, unnest(list(p)) AS p FROM (SELECT r, p, w[p:p + 4] AS win FROM places) GROUP BY r, win HAVING count(*) > 1),
again AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY 1),
measured AS (
  SELECT doc_id, source AS host, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_SOLID})) AS lines, coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN again USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged WHERE host IS NOT NULL GROUP BY 1),
moments AS (SELECT sum(f) / sum(n) AS mean, var_pop(f / n) AS spread, avg(1 / n) AS thin FROM hosts),
prior AS (
  SELECT mean, least(greatest(mean * (1 - mean) / greatest(spread - mean * (1 - mean) * thin, 1e-6) - 1, 1), 1e6) AS strength FROM moments),
rates AS (SELECT host, (f + mean * strength) / (n + strength) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept, round(rate, 6) AS host_rate
FROM judged LEFT JOIN rates USING (host)
"""

NGRAM_JACCARD = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, {_SOLID}) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM texts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM texts UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM texts LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1) USING (doc_id)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM payloads
"""

CHAT_FORMATTING = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, n, r, chr(92) || '### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
-- an escape for each backslash, each slash after a less-than sign, and each # after another; in roles for colons too
sized AS (
  SELECT *, len('### : </turn>' || chr(10)) + len(role || t) + len(role) - len(replace(role, ':', ''))
    + list_sum(list_transform([role, t], lambda x: len(x) - len(replace(x, chr(92), '')) + (len(x) - len(replace(x, '</', ''))) // 2
      + list_sum(list_prepend(0, list_transform(regexp_extract_all(x, '#+'), lambda y: len(y) - 1))))) AS n
  FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(len(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _value(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_value, ["doc_id", "source", "lang", "n_chars", text])) + ")"


_LOWER_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# a bit at a time, from the lowest of each byte on
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i:
  list_transform(range(0, 8), lambda b: (ascii(CAST(doc_id AS VARCHAR)[i]) >> b::INT) & 1)))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS h, CASE WHEN coalesce({_CRC32} % 5 = 0, false) THEN {_leaf(_LOWER_TEXT)} ELSE {_leaf('text')} END AS tried
  FROM documents),
placed AS (
  SELECT row_number() OVER () AS r, *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
nodes AS (
  SELECT source, 0 AS lvl, i, n, h FROM placed
  UNION ALL
  SELECT source, lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY source, lvl, i // 16, n),
tops AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n, lvl AS tall FROM nodes WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, i, n, h FROM tops
  UNION ALL
  SELECT lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY lvl, i // 16, n),
others AS (
  SELECT r, d.lvl, string_agg(d.h, '' ORDER BY d.i) FILTER (d.i < p.i // (16 ** d.lvl)::BIGINT) AS low, string_agg(d.h, '' ORDER BY d.i) FILTER (d.i > p.i // (16 ** d.lvl)::BIGINT) AS high
  FROM placed p JOIN nodes d ON d.source IS NOT DISTINCT FROM p.source AND d.n > 1 AND d.i // 16 = p.i // (16 ** (d.lvl + 1))::BIGINT GROUP BY ALL
  UNION ALL
  SELECT r, tall + c.lvl, string_agg(c.h, '' ORDER BY c.i) FILTER (c.i < t.i // (16 ** c.lvl)::BIGINT), string_agg(c.h, '' ORDER BY c.i) FILTER (c.i > t.i // (16 ** c.lvl)::BIGINT)
  FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source JOIN crown c ON c.n > 1 AND c.i // 16 = t.i // (16 ** (c.lvl + 1))::BIGINT GROUP BY ALL),
steps AS (SELECT r, lvl, coalesce(low, '') AS low, coalesce(high, '') AS high FROM others),
climb AS (
  SELECT r, 0 AS lvl, tried AS h FROM placed
  UNION ALL
  SELECT c.r, c.lvl + 1, sha256(low || h || high) FROM climb c JOIN steps s ON s.r = c.r AND s.lvl = c.lvl),
folded AS (SELECT r, arg_max(h, lvl) AS folded_root FROM climb GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(low || high, '' ORDER BY lvl)) AS proof FROM steps GROUP BY r)
SELECT p.doc_id, p.h AS leaf, t.h AS subroot, c.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = c.h AS verified
FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source JOIN crown c ON c.n = 1 JOIN folded USING (r) LEFT JOIN proofs USING (r)
"""
