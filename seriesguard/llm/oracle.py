"""DuckDB SQL for the training-data queries that SQL can express."""

OP1 = """
WITH RECURSIVE src AS (
  SELECT coalesce('=' || source, 'null') AS stream, doc_id, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS code
  FROM documents),
sized AS (SELECT stream, count(*) AS n FROM src GROUP BY 1),
st AS (
  SELECT stream, n, greatest(1, CAST(floor(greatest(200, 20 * count(*) OVER ())::DOUBLE * pow(n::DOUBLE, 0.5) / sum(pow(n::DOUBLE, 0.5)) OVER () + 0.5) AS BIGINT)) AS share,
         (n + 31) // 32 AS blocks
  FROM sized),
kinds AS (SELECT DISTINCT unnest([0, blocks // share, blocks // share + 1]) AS r0 FROM st),
quota AS (
  SELECT r0, stream, greatest(0, least(share, blocks - r0 * share)) AS q,
         sum(least(blocks, r0 * share)) OVER (PARTITION BY r0) AS base
  FROM kinds, st),
rounds AS (
  SELECT r0, any_value(base)::BIGINT AS base, sum(q)::BIGINT AS slots, list(stream ORDER BY stream) AS names,
         list(q::BIGINT ORDER BY stream) AS q
  FROM quota WHERE q > 0 GROUP BY r0),
edf AS (
  SELECT r0, base, slots, names, q, CAST(-1 AS BIGINT) AS t, list_transform(q, lambda x: 0::BIGINT) AS done, 0::BIGINT AS pick
  FROM rounds
  UNION ALL
  SELECT r0, base, slots, names, q, t + 1, list_transform(range(1, len(q) + 1), lambda i: done[i] + CAST(i = p AS BIGINT)), p
  FROM (
    SELECT *, list_sort(list_transform(
      list_filter(range(1, len(q) + 1), lambda i: done[i] < q[i] AND (done[i] * slots) // q[i] <= t + 1),
      lambda i: struct_pack(due := ((done[i] + 1) * slots + q[i] - 1) // q[i], i := i)))[1].i AS p
    FROM edf WHERE t + 1 < slots)),
plan AS (
  SELECT r0, base, slots, names[pick] AS stream, t AS slot,
         row_number() OVER (PARTITION BY r0, pick ORDER BY t) - 1 AS j
  FROM edf WHERE t >= 0),
ranked AS (
  SELECT stream, doc_id, row_number() OVER (PARTITION BY stream ORDER BY code, doc_id NULLS FIRST) - 1 AS rank FROM src),
blocked AS (SELECT *, rank // 32 AS block, (rank // 32) // share AS r FROM ranked JOIN st USING (stream)),
slotted AS (
  SELECT b.doc_id, b.stream, b.rank, b.block, p.base + (b.r - p.r0) * p.slots + p.slot AS slot
  FROM blocked b
  JOIN (SELECT r0, lead(r0) OVER (ORDER BY r0) AS r1 FROM (SELECT DISTINCT r0 FROM plan)) k
    ON b.r >= k.r0 AND (k.r1 IS NULL OR b.r < k.r1)
  JOIN plan p ON p.r0 = k.r0 AND p.stream = b.stream AND p.j = b.block % b.share)
SELECT doc_id, stream AS source_stream, CAST(block AS BIGINT) AS mix_block, CAST(slot AS BIGINT) AS mix_slot,
       CAST(row_number() OVER (ORDER BY slot, rank) - 1 AS BIGINT) AS mix_position
FROM slotted
"""

OP7 = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
k AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, f.holder IS NOT NULL AND k.doc_id <> f.holder AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
split AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS w1, unnest(range(len(w))) AS pos FROM split),
seq AS (
  SELECT lang, w1, lead(w1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3
  FROM words WINDOW piece AS (PARTITION BY id ORDER BY pos)),
f1 AS (SELECT lang, w1, count(*) AS f FROM seq GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM seq WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM seq WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
held AS (
  SELECT lang, u, v, max(f) AS most
  FROM (SELECT lang, w1 AS u, w2 AS v, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  LEFT JOIN held h ON h.lang = c.lang AND h.u = c.w1 AND h.v = c.w2
  WHERE c.f >= 10 AND (h.most IS NULL OR 100 * h.most < 50 * c.f)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS c FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE c = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

OP12 = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN 'row ' || row_number() OVER () ELSE 'id ' || conv_id END AS talk,
         coalesce(role, '') AS who, coalesce(text, '') AS said FROM c),
esc AS (
  SELECT *, regexp_replace(said, '([\[<])(\\*)(/?(?:INST|SYS|ROLE|SAYS|s)[\]>])', '\1\2\\\3', 'g') AS written,
         regexp_replace(who, '([\[<])(\\*)(/?(?:INST|SYS|ROLE|SAYS|s)[\]>])', '\1\2\\\3', 'g') AS name,
         row_number() OVER (PARTITION BY talk ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rn,
         count(*) OVER (PARTITION BY talk) AS size
  FROM t),
pieces AS (
  SELECT *, length(CASE who WHEN 'system' THEN '[SYS] ' || written || ' [/SYS]' WHEN 'user' THEN '[INST] ' || written || ' [/INST]'
                   WHEN 'assistant' THEN '<s>' || written || '</s>' ELSE '[ROLE] ' || name || ' [SAYS] ' || written || ' [/ROLE]' END) AS chars
  FROM esc),
upto AS (SELECT *, sum(chars) OVER (PARTITION BY talk ORDER BY rn) AS total FROM pieces)
SELECT any_value(conv_id) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(who || chr(10) || said || chr(10), '' ORDER BY rn)) AS turns_sha256,
       length(coalesce(string_agg(said, '' ORDER BY rn) FILTER (who = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(said, '' ORDER BY rn) FILTER (who = 'assistant'), '')) AS loss_sha256,
       CAST(sum(total) FILTER (who = 'assistant' OR rn = size) AS BIGINT) AS formatted_chars
FROM upto GROUP BY talk
"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
seq AS (SELECT doc_id, unnest(w) AS w1, unnest(range(len(w))) AS pos FROM d WHERE len(w) >= 3),
runs AS (
  SELECT doc_id, w1 || ' ' || lead(w1) OVER o || ' ' || lead(w1, 2) OVER o AS s FROM seq WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM runs WHERE s IS NOT NULL),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
near AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes z USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1) m USING (doc_id)
"""
