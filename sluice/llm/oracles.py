"""DuckDB SQL for the queries that SQL can express."""

# Patterns and letters shared by the statements.
_BLANKS = r"[\x20\x09-\x0D]"
_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, regexp_extract_all(text, '{_WORDS}') AS ws FROM d
), win AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), dup AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words FROM dup GROUP BY rid
), ln AS (
  SELECT rid, doc_id, host, line FROM (SELECT rid, doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dl AS (
  SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM ln GROUP BY rid
), norm AS (
  SELECT rid, doc_id, host, len(regexp_extract_all(line, '{_WORDS}')) AS n,
         translate(array_to_string(regexp_extract_all(line, '{_WORDS}'), ' '), '{_UP}', '{_LOW}') AS line
  FROM ln
), hosts AS (
  SELECT host, count(*) AS host_docs FROM (SELECT DISTINCT host, doc_id FROM d) GROUP BY host
), common AS (
  SELECT f.host, f.line FROM (
    SELECT host, line, count(*) AS n_docs FROM (SELECT DISTINCT host, line, doc_id FROM norm) GROUP BY host, line
  ) f JOIN hosts h ON f.host IS NOT DISTINCT FROM h.host
  WHERE f.n_docs > 10 AND (f.n_docs > h.host_docs * 0.02 OR f.n_docs > 1000)
), gone AS (
  SELECT n.rid, sum(n.n)::BIGINT AS n_removed
  FROM norm n JOIN common c ON n.line = c.line AND n.host IS NOT DISTINCT FROM c.host GROUP BY n.rid
), m AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
         length(regexp_replace(d.text, '{_BLANKS}', '', 'g'))::BIGINT AS word_chars,
         (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dl.n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n_repeat_words, 0) AS n_repeat_words,
         coalesce(gone.n_removed, 0) AS n_removed
  FROM d JOIN w USING (rid) LEFT JOIN dl USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)
)
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_removed > n_words * 0.7) AS kept
FROM m
"""

OP8 = rf"""
WITH s AS (
  SELECT doc_id, source, size, v - floor(v) AS u FROM (
    SELECT *, u + nth::DOUBLE * 0.6180339887498949::DOUBLE AS v FROM (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size,
             ('0x' || md5('mix-1' || chr(31) || coalesce(doc_id::VARCHAR, '') || chr(31) || md5(coalesce(text, '')))[1:13])::BIGINT
               / 4503599627370496.0::DOUBLE AS u,
             row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) - 1 AS nth
      FROM documents))
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1 AS weight
  FROM s GROUP BY source
), lev AS (
  SELECT *, 3 * source_size AS ceiling, (3.0 * source_size)::DOUBLE / weight AS fill FROM src
), run AS (
  SELECT *, coalesce(sum(ceiling) OVER (ORDER BY fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         sum(source_size) OVER () AS tokens
  FROM lev
), stop AS (
  SELECT tokens - held AS spare, rest FROM run
  WHERE (tokens - held)::DOUBLE / rest <= fill ORDER BY fill LIMIT 1
), t AS (
  SELECT lev.source, lev.source_size,
         CASE WHEN lev.ceiling * stop.rest < lev.weight * stop.spare THEN lev.ceiling::DOUBLE
              ELSE (lev.weight * stop.spare)::DOUBLE / stop.rest::DOUBLE END AS target
  FROM lev, stop
), r AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, least(floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 3)::BIGINT AS copies FROM r
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM c
"""

_CTRL = r"(<|\[)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])"
OP10 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '{_CTRL}', '\1\\\2', 'g')) AS body,
         length(replace(regexp_replace(replace(role, '\', '\\'), '{_CTRL}', '\1\\\2', 'g'), chr(10), '\n')) AS head
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + head + 1 + body + 11)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP5 = rf"""
WITH ln AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^{_BLANKS}+|{_BLANKS}+$', '', 'g'), '{_UP}', '{_LOW}') AS key
  FROM ln
), c AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND k.doc_id <> c.last_doc) AS gone FROM k LEFT JOIN c USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP7 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_TERMS}') AS ws
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_TERMS}') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT n FROM bw
), dw AS (
  SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)
), hit AS (
  SELECT dw.rid, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win
), pos AS (
  SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid
), its AS (
  SELECT rid, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(pos.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

OP11 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT text, min(doc_id) AS least FROM t GROUP BY text
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), w AS (
  SELECT *, regexp_extract_all(text, '{_WORDS}') AS ws FROM t
), d AS (
  SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         map(['A', 'B', 'C', 'D', 'E'], [
           len(ws) < 50,
           100 * len(list_distinct(ws)) < 65 * len(ws),
           100 * (length(w.text) - length(regexp_replace(w.text, '[A-Z]', '', 'g'))) > 5 * length(w.text),
           regexp_matches(w.text, '[#$%&*|]'),
           coalesce(m.least < w.doc_id, false)]) AS f
  FROM w JOIN m ON w.text = m.text LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, good, toxic, f, count(*) AS n FROM d GROUP BY ALL
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, step, filter_order[step] AS letter, string_split(filter_order[1:step - 1], '') AS before
  FROM o, (SELECT unnest(range(1, 6))::INT AS step)
), r AS (
  SELECT part, filter_order, step, letter, n, good, toxic, f[letter] AS fails,
         list_bool_or(list_transform(before, lambda b: coalesce(f[b], false))) AS gone,
         len(list_filter(map_values(f), lambda v: v)) = 1 AS alone
  FROM c, s
), g AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT fails AND NOT coalesce(gone, false)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails AND NOT coalesce(gone, false)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails AND coalesce(gone, false)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails AND alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (fails AND NOT coalesce(gone, false) AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (fails AND NOT coalesce(gone, false) AND toxic), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM g
"""

OP12 = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), n AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k
), f AS (
  SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k, count(*)::BIGINT AS f FROM g GROUP BY ALL HAVING count(*) >= 30
), c AS (
  SELECT lang, phrase, string_split(phrase, ' ') AS ws, k AS size, f AS a FROM f WHERE k >= 2
), cut AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)
), s AS (
  SELECT cut.lang, cut.phrase, cut.a, cut.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * cut.a) // (x.f + y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.head JOIN f y ON y.lang = cut.lang AND y.phrase = cut.tail
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM c)) GROUP BY ALL
), best AS (
  SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
  FROM low LEFT JOIN held ON held.lang = low.lang AND held.phrase = low.phrase
  WHERE held.longer IS NULL OR NOT (100::HUGEINT * held.longer >= 80::HUGEINT * low.a)
)
SELECT best.lang, rank, phrase, a, l, r, n, score FROM best JOIN n ON n.lang = best.lang WHERE rank <= 2000
"""

ORACLES = {
    "op2_quality_rules": OP2,
    "op5_line_dedup": OP5,
    "op7_decontaminate": OP7,
    "op8_mix_sources": OP8,
    "op10_chat_format": OP10,
    "op11_filter_audit": OP11,
    "op12_collocations": OP12,
}
