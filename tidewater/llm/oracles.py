"""DuckDB SQL for the queries that SQL can express on whole tables.

Hash functions that DuckDB lacks (XXH64, crc32), trained models, tokenizers,
HTML and bin packing have none; tests hold brute-force versions of those.
"""

W = r"[^\x20\x09-\x0D]+"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.x = v.vec_id) AS n_links,
       r.c AS component_id, v.vec_id = r.c AS kept
FROM v JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON r.x = v.vec_id
"""

OP2 = rf"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, n, list_distinct(regexp_extract_all(
           translate(ls[n], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '{W}')) AS ws
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS n FROM split)),
sized AS (SELECT row_number() OVER (ORDER BY doc_id, n) AS i, doc_id, n, ws, len(ws) AS k
          FROM lines WHERE len(ws) > 0),
tokens AS (SELECT i, k, unnest(ws) AS w FROM sized),
gone AS (
  SELECT DISTINCT x AS i FROM (
    SELECT a.i AS x, b.i AS y, a.k AS kx, b.k AS ky, count(*) AS o
    FROM tokens a JOIN tokens b ON a.w = b.w AND b.i < a.i
      AND 5 * b.k >= 4 * a.k AND 5 * a.k >= 4 * b.k
    GROUP BY ALL)
  WHERE 5 * o >= 4 * (kx + ky - o)),
bad AS (SELECT doc_id, list(n) AS g FROM sized JOIN gone USING (i) GROUP BY doc_id)
SELECT s.doc_id,
       CASE WHEN g IS NULL THEN text ELSE array_to_string(
         [ls[n] FOR n IN range(1, len(ls) + 1) IF NOT list_contains(g, n)], chr(10)) END AS text,
       coalesce(len(ls), 0) AS n_lines, coalesce(len(g), 0) AS n_removed
FROM split s LEFT JOIN bad ON bad.doc_id = s.doc_id
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{W}') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10))
          IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i:i + 4] AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows)
  WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY doc_id),
s AS (
  SELECT d.doc_id, lang, source, len(ws) AS n_words,
         CAST(coalesce(list_sum([length(w) FOR w IN ws]), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeated r ON r.doc_id = d.doc_id),
rates AS (
  SELECT *, CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars END AS symbols,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines END AS dup_lines,
         CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words END AS repeats,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END AS word_length
  FROM s),
long AS (
  SELECT lang, source, 'symbols' AS rate, symbols AS v, 4.0 AS least FROM rates
  UNION ALL SELECT lang, source, 'dup_lines', dup_lines, 75.0 FROM rates
  UNION ALL SELECT lang, source, 'repeats', repeats, 50.0 FROM rates
  UNION ALL SELECT lang, source, 'word_length', word_length, 75.0 FROM rates),
b AS (
  SELECT lang, source, rate, least, CASE WHEN v < 100 THEN v ELSE CAST(rpad(
    substr(CAST(v AS VARCHAR), 1, 2), CAST(length(CAST(v AS VARCHAR)) AS INTEGER), '0') AS BIGINT)
    END AS v FROM long WHERE v IS NOT NULL),
keyed AS (
  SELECT 1 AS level, lang, source, rate, least, v FROM b
  UNION ALL SELECT 2, lang, NULL, rate, least, v FROM b
  UNION ALL SELECT 3, NULL, NULL, rate, least, v FROM b),
upto AS (
  SELECT level, lang, source, rate, least, v,
         sum(count(*)) OVER (PARTITION BY level, lang, source, rate ORDER BY v) AS upto,
         sum(count(*)) OVER (PARTITION BY level, lang, source, rate) AS n
  FROM keyed GROUP BY level, lang, source, rate, least, v),
q AS (
  SELECT level, lang, source, rate, least, max(n) AS n,
         min(v) FILTER (upto >= CAST(0.1 AS DOUBLE) * n) AS lo,
         min(v) FILTER (upto >= CAST(0.5 AS DOUBLE) * n) AS mid,
         min(v) FILTER (upto >= CAST(0.9 AS DOUBLE) * n) AS hi
  FROM upto GROUP BY level, lang, source, rate, least),
lim AS (
  SELECT *, mid - 4.0 * greatest(least(mid - lo, hi - mid), least) AS low,
         mid + 4.0 * greatest(least(mid - lo, hi - mid), least) AS high
  FROM (SELECT level, lang, source, rate, n, lo, mid, hi, q.least AS least FROM q)),
chosen AS (
  SELECT a.lang, a.source, a.rate,
         CASE WHEN a.n >= 200 THEN a.low WHEN l.n >= 200 THEN l.low ELSE c.low END AS low,
         CASE WHEN a.n >= 200 THEN a.high WHEN l.n >= 200 THEN l.high ELSE c.high END AS high
  FROM lim a JOIN lim l ON l.level = 2 AND l.rate = a.rate AND l.lang IS NOT DISTINCT FROM a.lang
  JOIN lim c ON c.level = 3 AND c.rate = a.rate WHERE a.level = 1),
wide AS (
  SELECT lang, source, max(high) FILTER (rate = 'symbols') AS sy,
         max(high) FILTER (rate = 'dup_lines') AS du, max(high) FILTER (rate = 'repeats') AS re,
         max(low) FILTER (rate = 'word_length') AS wl, max(high) FILTER (rate = 'word_length') AS wh
  FROM chosen GROUP BY lang, source),
judged AS (
  SELECT r.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         coalesce(symbols <= sy, true) AND coalesce(dup_lines <= du, true)
         AND coalesce(repeats <= re, true) AND coalesce(word_length BETWEEN wl AND wh, true) AS fine
  FROM rates r LEFT JOIN wide w ON w.lang IS NOT DISTINCT FROM r.lang
    AND w.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND fine AS kept
FROM judged
"""

OP8 = r"""
WITH kinds(kind, nth, start0, tell, pattern, speaks) AS (VALUES
  ('email', 1, 0.8, '@', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+',
   'e-?mail|mail|contact|write|correo|courriel'),
  ('ip', 2, 0.6, '\.[0-9]+\.[0-9]', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)',
   'ip|address|server|host|login|adresse'),
  ('card', 3, 0.8, '(?:[0-9][\x20-]?){12}[0-9]', '[0-9]([\x20-]?[0-9])+',
   'card|visa|mastercard|credit|debit|payment|tarjeta|carte|karte'),
  ('phone', 4, 0.7, '\+[0-9]', '\+[0-9][\x20().0-9-]+[0-9]',
   'tel|phone|call|fax|mobile|telefon|telefono|telephone'),
  ('iban', 5, 0.7, '[A-Z]{2}[0-9]{2}',
   '\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b',
   'iban|account|bank|konto|compte|cuenta|bic'),
  ('ssn', 6, 0.4, '[0-9]-[0-9]{2}-[0-9]', '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b',
   'ssn|social security|tax id'),
  ('localphone', 7, 0.4, '[0-9][\x20.-][0-9]{4}',
   '(?:\([0-9]{3}\)\x20?|\b[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}\b',
   'tel|phone|call|fax|mobile|telefon|telefono|telephone')),
found AS (
  SELECT doc_id, coalesce(text, '') AS t, k.*, regexp_extract_all(coalesce(text, ''), pattern) AS ms,
         string_split_regex(coalesce(text, ''), pattern) AS gaps
  FROM documents, kinds k WHERE regexp_matches(coalesce(text, ''), tell)),
each AS (
  SELECT *, ms[i] AS s, CAST(list_sum([length(g) FOR g IN gaps[1:i]])
           + coalesce(list_sum([length(m) FOR m IN ms[1:i - 1]]), 0) AS BIGINT) AS a
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found)),
read AS (
  SELECT *, a + length(s) AS z, regexp_replace(s, '[^0-9]', '', 'g') AS digits,
         replace(s, ' ', '') AS tight,
         lower(substr(t, greatest(a - 40, 0) + 1, a - greatest(a - 40, 0)) || ' '
               || substr(t, a + length(s) + 1, 40)) AS around
  FROM each),
sound AS (
  SELECT * FROM read WHERE CASE kind
    WHEN 'ip' THEN list_max([CAST(right('00' || ltrim(p, '0'), 18) AS BIGINT)
                             FOR p IN string_split(s, '.')]) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(
      [CASE WHEN (length(digits) - i) % 2 = 0 THEN CAST(substr(digits, i, 1) AS INTEGER)
            WHEN CAST(substr(digits, i, 1) AS INTEGER) > 4
            THEN 2 * CAST(substr(digits, i, 1) AS INTEGER) - 9
            ELSE 2 * CAST(substr(digits, i, 1) AS INTEGER) END
       FOR i IN range(1, length(digits) + 1)]) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(tight) BETWEEN 15 AND 34 AND list_reduce(
      list_concat([CAST(0 AS BIGINT)], [CAST(CASE WHEN ascii(c) < 65 THEN ascii(c) - 48
                                          ELSE ascii(c) - 55 END AS BIGINT)
                    FOR c IN string_split(substr(tight, 5) || substr(tight, 1, 4), '')]),
      lambda x, y: CASE WHEN y < 10 THEN (x * 10 + y) % 97 ELSE (x * 100 + y) % 97 END) = 1
    WHEN 'ssn' THEN NOT regexp_matches(s, '^(?:000|666|9)|-00-|0000$')
    ELSE true END),
scored AS (
  SELECT *, round(least(greatest(CAST(start0 AS DOUBLE)
      + CASE WHEN regexp_matches(around, '(?:^|[^a-z])(?:' || speaks || ')(?:[^a-z]|$)')
             THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      - CASE WHEN regexp_matches(around,
                    '(?:^|[^a-z])(?:version|isbn|issn|build|chapter|page)(?:[^a-z]|$)')
             THEN CAST(0.4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, 0.0), 1.0), 2) AS score
  FROM sound),
iban AS (
  SELECT * FROM scored x WHERE kind = 'iban' AND score >= 0.6 AND NOT EXISTS (
    SELECT 1 FROM scored y WHERE y.doc_id = x.doc_id AND y.nth <= 4 AND y.a < x.z AND x.a < y.z)),
four AS (SELECT * FROM scored WHERE nth <= 4),
five AS (SELECT * FROM four UNION ALL SELECT * FROM iban),
six AS (
  SELECT * FROM five UNION ALL
  SELECT * FROM scored x WHERE kind = 'ssn' AND score >= 0.6 AND NOT EXISTS (
    SELECT 1 FROM five y WHERE y.doc_id = x.doc_id AND y.a < x.z AND x.a < y.z)),
seven AS (
  SELECT * FROM six UNION ALL
  SELECT * FROM scored x WHERE kind = 'localphone' AND score >= 0.6 AND NOT EXISTS (
    SELECT 1 FROM six y WHERE y.doc_id = x.doc_id AND y.a < x.z AND x.a < y.z)),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY nth, a) FILTER (nth <= 4) AS base,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY nth, a) AS spans,
         string_agg(CAST(score AS VARCHAR), ',' ORDER BY nth, a) AS scores
  FROM seven GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scores, '') AS scores
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""

OP10 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS key,
         coalesce(len(regexp_extract_all(text, '{W}')), 0) AS size,
         md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents),
b AS (
  SELECT *, length(CAST(size AS VARCHAR)) * 100
            + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INTEGER) AS bucket
  FROM d),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY bucket DESC, substr(draw, 1, 2),
                                    size DESC, draw) - 1 AS DOUBLE) AS pos
  FROM b),
sizes AS (
  SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY key, source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) AS rank,
         CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT) AS w
  FROM sizes),
summed AS (
  SELECT *, sum(w) OVER lev AS w_before, sum(3 * source_size) OVER lev AS full_before,
         sum(w) OVER () AS w_all, sum(source_size) OVER () AS total
  FROM ranked WINDOW lev AS (ORDER BY source_size * (6 // w), rank ROWS UNBOUNDED PRECEDING)),
stopped AS (
  SELECT *, full_before * w + 3 * source_size * (w_all - w_before) <= total * w AS stops
  FROM summed),
shared AS (
  SELECT *, total - sum(CASE WHEN stops THEN 3 * source_size ELSE 0 END) OVER () AS rest,
         sum(CASE WHEN stops THEN 0 ELSE w END) OVER () AS w_left
  FROM stopped),
targets AS (
  SELECT key, source_size, CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE)
           ELSE CAST(w AS DOUBLE) * (CAST(rest AS DOUBLE) / CAST(w_left AS DOUBLE)) END AS target
  FROM shared),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
rows_ AS (
  SELECT p.*, r.source_size, r.target, r.rate,
         (bucket % 100) * CAST(pow(10, greatest(bucket // 100 - 2, 0)) AS BIGINT) * 100
           >= r.source_size AND r.source_size > 0 AS large
  FROM placed p JOIN rated r USING (key)),
tries AS (
  SELECT key, k, CAST(CAST('0x' || substr(md5('42/' || k || '/' || key), 1, 8) AS BIGINT) AS DOUBLE)
                 / 4294967296.0 AS o
  FROM rated, (SELECT unnest(range(8)) AS k)),
first AS (
  SELECT t.key, t.k, t.o, count(*) FILTER (large) AS n_large,
         coalesce(sum(size) FILTER (large), 0) AS large_size,
         coalesce(sum(size * least(floor(rate * pos + o + rate) - floor(rate * pos + o), 3))
                  FILTER (large), 0) AS large_taken
  FROM rows_ JOIN tries t USING (key) GROUP BY t.key, t.k, t.o),
rest_rates AS (
  SELECT f.*, r.rate, r.target, CASE WHEN r.source_size - large_size > 0
           THEN greatest(0.0, least(3.0, (r.target - CAST(large_taken AS DOUBLE))
                                         / CAST(r.source_size - large_size AS DOUBLE)))
           ELSE r.rate END AS rest_rate
  FROM first f JOIN rated r USING (key)),
then_ AS (
  SELECT q.key, q.k, sum(size * least(
           floor(q.rate * n_large + rest_rate * (pos - n_large) + o + rest_rate)
           - floor(q.rate * n_large + rest_rate * (pos - n_large) + o), 3)) AS rest_taken
  FROM rows_ r JOIN rest_rates q USING (key) WHERE NOT large GROUP BY q.key, q.k),
best AS (
  SELECT * FROM (
    SELECT q.*, row_number() OVER (PARTITION BY key ORDER BY
             abs(CAST(large_taken AS DOUBLE) + coalesce(CAST(rest_taken AS DOUBLE), 0.0) - target), k
             ) AS nth
    FROM rest_rates q LEFT JOIN then_ USING (key, k)) WHERE nth = 1)
SELECT doc_id, size, r.source_size, r.target, CAST(size * least(CASE WHEN large
         THEN floor(r.rate * pos + o + r.rate) - floor(r.rate * pos + o)
         ELSE floor(r.rate * n_large + rest_rate * (pos - n_large) + o + rest_rate)
              - floor(r.rate * n_large + rest_rate * (pos - n_large) + o) END, 3) AS BIGINT) AS taken
FROM rows_ r JOIN best USING (key)
"""



def _op11(rounds: int = 6) -> str:
    """One pair of steps a round: nearest entries, then the entries' new components."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, part, min(CAST(d AS HUGEINT) * 32 + entry) AS k FROM (
    SELECT rid, part, entry, sum((c - v) * (c - v)) AS d FROM cut JOIN b{r} USING (part, pos)
    GROUP BY rid, part, entry) GROUP BY rid, part)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(m, v) AS v FROM b{r} LEFT JOIN (
    SELECT part, k % 32 AS entry, pos,
           CAST((sum(c) - (sum(c) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM cut JOIN a{r} USING (rid, part) GROUP BY ALL) USING (part, entry, pos))""")
    return f"""
WITH v AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) AS rid
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
cut AS MATERIALIZED (
  SELECT rid, (i - 1) // (w // 8) AS part, (i - 1) % (w // 8) AS pos,
         CAST(floor(4096 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS c
  FROM (SELECT rid, embedding AS e, len(embedding) AS w,
               unnest(range(1, len(embedding) + 1)) AS i FROM v)),
b0 AS MATERIALIZED (
  SELECT part, rid - 1 AS entry, pos, c AS v FROM cut WHERE rid <= 16),
{", ".join(steps)},
coded AS (
  SELECT rid, string_agg(printf('%02x', CAST(k % 32 AS INTEGER)), '' ORDER BY part) AS code,
         CAST(sum(k // 32) AS BIGINT) AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos))
        FROM b{rounds}) AS codebooks_sha256
FROM v JOIN coded USING (rid)
"""


OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''),
           '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
n AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1,
         CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
cut AS (
  SELECT doc_id, t, n, array_to_string(u[1:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s,
         CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

ORACLES = {
    "op1_embedding_near_dedup": OP1,
    "op2_line_dedup": OP2,
    "op7_quality_rules": OP7,
    "op8_pii": OP8,
    "op10_source_mixing": OP10,
    "op11_vector_codes": _op11(),
    "op13_fill_in_middle": OP13,
}
