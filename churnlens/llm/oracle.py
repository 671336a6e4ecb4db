"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_STOP = """'a','an','and','are','as','at','be','by','for','from','he','her','his','in','is','it',
'not','of','on','or','that','the','their','this','to','was','with','au','aux','avec','ce','dans',
'des','du','elle','est','et','il','la','le','les','ne','ou','par','pas','pour','que','qui','se',
'son','sur','un','une','auf','aus','bei','das','dem','den','der','die','ein','eine','einer','für',
'ich','im','ist','mit','nicht','sich','sie','und','von','zu','al','como','con','de','del','el',
'en','las','lo','los','no','o','para','por','su','una','y'"""

CHAT = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         coalesce(CAST(floor(turn / 256.0) AS BIGINT), -1) AS part
  FROM conversations WHERE conv_id IS NOT NULL),
who AS (SELECT DISTINCT conv_id, role AS perspective FROM said),
msg AS (
  SELECT conv_id, perspective, part, turn, role, text, role = perspective AS own,
         CASE WHEN role = perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user:' || regexp_replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'),
                                               '\|(\\*)>', '|\\\1>', 'g') || '|>' || chr(10) END AS head,
         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10) AS body
  FROM said JOIN who USING (conv_id)),
put AS (
  SELECT *, row_number() OVER w AS k,
         sum(length(head) + length(body)) OVER w - length(body) AS begin_at
  FROM msg
  WINDOW w AS (PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, perspective, part, count(*) AS n_messages,
       CAST(coalesce(sum(length(body)) FILTER (own), 0) AS BIGINT) AS n_trained,
       string_agg(head || body, '' ORDER BY k) AS rendered,
       coalesce(string_agg(CAST(CAST(begin_at AS BIGINT) AS VARCHAR) || '+' || length(body), ','
                           ORDER BY k) FILTER (own), '') AS spans
FROM put GROUP BY conv_id, perspective, part
"""

URLS = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM cut),
base(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT p.page_id, p.host, p.path,
         arg_max(b.host || b.path, length(b.host || b.path)) AS rule,
         arg_max(b.verdict, length(b.host || b.path)) AS verdict
  FROM parsed p LEFT JOIN base b
    ON (p.host = b.host OR ends_with(p.host, '.' || b.host)) AND starts_with(p.path, b.path)
  GROUP BY p.page_id, p.host, p.path),
general(name, pattern, size) AS (VALUES
  ('login pages', '/login/', 7), ('sign-up pages', '/signup/', 8), ('carts', '/cart/', 6),
  ('checkouts', '/checkout/', 10), ('tag listings', '/tag/', 5), ('search results', '/search/', 8),
  ('archives', '[.]zip$', 5), ('programs', '[.]exe$', 5), ('images', '[.]jpg$', 5),
  ('scripts', '[.]js$', 4), ('advert hosts', '^([^/]*[.])?ads[.]', 5),
  ('tracker hosts', '^([^/]*[.])?tracker[.]', 9)),
hit AS (
  SELECT f.page_id, arg_max(g.name, (g.size, g.name)) AS name
  FROM fit f JOIN general g ON f.rule IS NULL AND regexp_matches(f.host || f.path, g.pattern)
  GROUP BY f.page_id)
SELECT f.page_id, f.host, f.path, f.rule,
       coalesce(f.verdict, CASE WHEN h.name IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       h.name AS pattern_rule
FROM fit f LEFT JOIN hit h USING (page_id)
"""

RULES = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, list_slice(words, i, i + 4) AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({_STOP}))) AS n_stop,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper
  FROM w LEFT JOIN covered USING (doc_id)),
v AS (
  SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2,
         word_chars < 2 * n_words OR word_chars > 12 * n_words AS f3,
         100 * n_symbols > 10 * n_words AS f4, 100 * n_dup_lines > 50 * n_lines AS f5,
         n_words >= 40 AND 100 * n_stop < 5 * n_words AS f6,
         100 * n_upper > 40 * word_chars AS f7
  FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f1 OR f2 AS base_failed, NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7) AS kept,
       array_to_string(list_filter([
         CASE WHEN f1 THEN 'length' END, CASE WHEN f2 THEN 'repeated_windows' END,
         CASE WHEN f3 THEN 'mean_word_length' END, CASE WHEN f4 THEN 'symbols_per_word' END,
         CASE WHEN f5 THEN 'duplicate_lines' END, CASE WHEN f6 THEN 'stop_words' END,
         CASE WHEN f7 THEN 'upper_case' END], lambda x: x IS NOT NULL), ',') AS failed_rules
FROM v
"""

_COMPONENTS = """
reach(id, seen) AS (
  SELECT a, b FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.seen),
part AS (SELECT id, least(id, min(seen)) AS component FROM reach GROUP BY id)
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q
    ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
   AND p.norm > 0 AND q.norm > 0 AND list_dot_product(p.e, q.e) / (p.norm * q.norm) >= 0.98),
{_COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
       coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN part ON part.id = vec_id
"""

MINHASH = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, list_slice(words, i, i + 4) AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w
        WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c
  FROM g p JOIN g q ON p.gram = q.gram AND p.doc_id <> q.doc_id GROUP BY p.doc_id, q.doc_id),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       d.doc_id = coalesce(component, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN part ON part.id = d.doc_id
"""

#: Unsigned CRC-32 of decimal text, by table; ``_crc(bytes)`` wants crc_table in the FROM list.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
                                                 ELSE c >> 1 END, i) ORDER BY i) AS crc_t
  FROM range(256) r(i))"""


def _crc(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return (f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, crc_t[(xor(c, b) & 255) + 1]), "
            "4294967295), 4294967295)")


PERIODIC = rf"""
WITH {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, {_crc("CAST(doc_id AS VARCHAR)")} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents, crc_table),
p AS (
  SELECT *, len(ws) AS n, (h // 10) % nullif(len(ws), 0) AS a, 3 + (h // 10) % 8 AS parts FROM d),
looped AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i
                        ELSE a + (i - a) % (1 + (n - a) // parts) END + 1]) ELSE ws END AS ws
  FROM p),
tok AS (SELECT r, n, i, ws[i + 1] AS w FROM (SELECT *, unnest(range(n)) AS i FROM looped)),
gram AS (
  SELECT l.r, l.n, i, array_to_string(list_slice(ws, i + 1, i + 5), ' ') AS g
  FROM (SELECT *, unnest(range(n - 4)) AS i FROM looped WHERE n > 4) l),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM gram x JOIN gram y
    ON x.r = y.r AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (
  SELECT r, q, min(i) AS s, max(i) - min(i) + 5 + q AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs)
  GROUP BY r, q, island),
long AS (SELECT * FROM stretch WHERE len >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM long t WHERE NOT EXISTS (
    SELECT 1 FROM long u WHERE u.r = t.r AND u.q < t.q AND u.s <= t.s AND u.s + u.len >= t.s + t.len)),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM tok ANTI JOIN gone USING (r, i) GROUP BY r),
best AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t,
         arg_max([s, len, q], (len, -s, -q)) AS b
  FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b[1] AS start, b[2] AS length, b[3] AS period,
       1000 * b[2] // b[3] AS exponent_milli, sha256(coalesce(best.t, '')) AS runs_sha256,
       sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM looped LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""

#: One row after the other, the cheapest audit per role state (0 nothing yet, 1 after system,
#: 2 after user, 3 after assistant); up to two insertions stand before a row or at the end.
REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
fate AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}
           % 20 AS f
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
           AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fate WHERE f <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM damaged),
r AS (
  SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last
  FROM placed),
k AS (
  SELECT c, conv_id, i, turn, role, text, left(role, 1) AS initial,
         last = '' AS blank, last <> '' AND again AS duplicate,
         last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
  FROM r),
ins(p, q, letters, cost) AS (VALUES
  (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0),
  (0, 2, 'I', 5), (1, 2, 'I', 5), (3, 2, 'I', 5), (2, 3, 'I', 5),
  (0, 3, 'II', 10), (1, 3, 'II', 10), (2, 2, 'II', 10), (3, 3, 'II', 10)),
role(p, q, initial, name) AS (VALUES (0, 1, 's', NULL), (0, 2, 'u', 'user'), (1, 2, 'u', 'user'),
  (3, 2, 'u', 'user'), (2, 3, 'a', 'assistant')),
step AS (
  SELECT c, i, s.p, s.p AS q, 'D' AS letter, 2 AS cost, NULL AS line
  FROM k, (VALUES (0), (1), (2), (3)) s(p)
  UNION ALL
  SELECT c, i, p, q, 'K', CASE WHEN truncated THEN 5 ELSE 0 END, k.role || ':' || text
  FROM k JOIN role USING (initial) WHERE NOT blank AND NOT duplicate
  UNION ALL
  SELECT c, i, p, q, 'R', CASE WHEN truncated THEN 6 ELSE 1 END, name || ':' || text
  FROM k, role WHERE name IS NOT NULL AND NOT blank AND NOT duplicate),
move AS (
  SELECT c, i, ins.p, step.q, ins.cost + step.cost AS cost, letters || letter AS audit,
         CASE letters WHEN '' THEN [] WHEN 'I' THEN [CASE ins.p WHEN 2 THEN 'assistant:' ELSE 'user:' END]
              ELSE [CASE ins.p WHEN 2 THEN 'assistant:' ELSE 'user:' END,
                    CASE ins.p WHEN 2 THEN 'user:' ELSE 'assistant:' END] END
           || CASE WHEN line IS NULL THEN [] ELSE [line] END AS lines
  FROM ins JOIN step ON ins.q = step.p),
best AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit,
         CAST([] AS VARCHAR[]) AS lines FROM k
  UNION ALL
  SELECT c, i, q, cost, audit, lines FROM (
    SELECT b.c, m.i, m.q, b.cost + m.cost AS cost, b.audit || m.audit AS audit, b.lines || m.lines AS lines,
           row_number() OVER (PARTITION BY b.c, m.q ORDER BY b.cost + m.cost, b.audit || m.audit) AS n
    FROM best b JOIN move m ON m.c = b.c AND m.i = b.i + 1 AND m.p = b.q)
  WHERE n = 1),
stats AS (
  SELECT c, any_value(conv_id) AS conv_id, max(i) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM k GROUP BY c),
done AS (
  SELECT c, min(CAST(cost + e.ec AS BIGINT)) AS cost,
         arg_min([audit || e.letters, array_to_string(lines || e.more, chr(10))],
                 (cost + e.ec, audit || e.letters)) AS x
  FROM best JOIN stats USING (c)
  JOIN (VALUES (0, 0, '', []), (3, 0, '', []), (2, 5, 'I', ['assistant:']),
               (1, 10, 'II', ['user:', 'assistant:'])) e(q, ec, letters, more) ON e.q = best.q
  WHERE i = n GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(x[1], '') AS audit,
       sha256(coalesce(x[2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN (stats JOIN done USING (c)) s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL = {
    "op2_chat_rotation": CHAT,
    "op4_url_filters": URLS,
    "op6_quality_rules": RULES,
    "op9_embedding_near_dedup": EMBEDDINGS,
    "op10_minhash_near_dedup": MINHASH,
    "op11_periodic_runs": PERIODIC,
    "op12_conversation_repair": REPAIR,
}
