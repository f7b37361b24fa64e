"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, role AS who,
         coalesce(nullif(regexp_replace(trim(coalesce(role, '')), '[\s<>|=#]+', '_', 'g'), ''), 'unknown') AS shown,
         replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations
), names AS (
  SELECT conv_id, who, CASE WHEN n = 1 THEN shown ELSE shown || '#' || n END AS speaker
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, shown ORDER BY who NULLS FIRST) AS n
        FROM (SELECT DISTINCT conv_id, who, shown FROM turns))
), people AS (
  SELECT conv_id, who AS me, speaker AS perspective FROM names WHERE who IS DISTINCT FROM 'system'
), seen AS (
  SELECT t.conv_id, p.me, p.perspective, t.turn, t.who, n.speaker, t.body,
         CASE WHEN t.who IS NOT DISTINCT FROM p.me THEN 'assistant' WHEN t.who = 'system' THEN 'system' ELSE 'user' END AS role
  FROM turns t
  JOIN names n ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.who IS NOT DISTINCT FROM n.who
  JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), segments AS (
  SELECT *, CASE WHEN role = 'user' THEN speaker END AS name,
         '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head
  FROM seen
), placed AS (
  SELECT *, head || body || '<|im_end|>' || chr(10) AS segment,
         length(head || body || '<|im_end|>' || chr(10)) AS size,
         coalesce(sum(length(head || body || '<|im_end|>' || chr(10))) OVER (
           PARTITION BY conv_id, me ORDER BY turn NULLS FIRST, who NULLS FIRST, md5(body)
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_at,
         row_number() OVER (PARTITION BY conv_id, me, turn ORDER BY who NULLS FIRST, md5(body)) AS part
  FROM segments
)
SELECT conv_id, perspective, turn, CAST(part AS INTEGER) AS part, role, name, segment,
       CAST(start_at AS BIGINT) AS start_at, CAST(start_at + size AS BIGINT) AS end_at,
       CASE WHEN role = 'assistant' THEN CAST(start_at + length(head) AS BIGINT) END AS mask_from,
       CASE WHEN role = 'assistant' THEN CAST(start_at + size - 11 AS BIGINT) END AS mask_to
FROM placed
"""

OP8 = """
WITH clean AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM clean q JOIN clean c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, CAST(vec_id AS BIGINT) AS vec_id,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 10
"""

OP9 = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][CAST(rank % 3 AS INTEGER) + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS stop FROM sources
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM weighed) * 1.5::DOUBLE
             - coalesce(sum(stop) OVER (ORDER BY stop / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY stop / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), held AS (
  SELECT level FROM levels WHERE level * weight <= stop ORDER BY stop / weight, rank LIMIT 1
), targets AS (
  SELECT source, source_size, rank, coalesce(least(stop, (SELECT level FROM held) * weight), stop) AS target FROM levels
), offers AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.rank, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.place, s.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offered
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), takes AS (
  SELECT *, least(greatest(CAST(floor(target) AS BIGINT) - offered, 0), size) AS first_take,
         least(greatest(CAST(floor(target) AS BIGINT) - offered - source_size, 0), size) AS second_take,
         CASE WHEN target > 0 THEN least(offered / target, 1.0) ELSE 0 END AS share
  FROM offers
)
SELECT doc_id, source, size, source_size, target, CAST(first_take + second_take AS BIGINT) AS taken,
       CASE WHEN first_take > 0 THEN round(CASE rank % 3
         WHEN 0 THEN share
         -- weights 2 -> 1 -> 0.5 at times 0, 0.5, 1: integral 0.75 + 0.375
         WHEN 1 THEN CASE WHEN share >= 0.75 / 1.125
           THEN 0.5 + (1.0 - sqrt(greatest(1.0 - 2.0 * (share * 1.125 - 0.75), 0))) / 1.0
           ELSE (2.0 - sqrt(4.0 - 4.0 * share * 1.125)) / 2.0 END
         -- weights 0.5 -> 1 -> 2 at times 0, 0.5, 1: integral 0.375 + 0.75
         ELSE CASE WHEN share >= 0.375 / 1.125
           THEN 0.5 + (sqrt(1.0 + 4.0 * (share * 1.125 - 0.375)) - 1.0) / 2.0
           ELSE (sqrt(0.25 + 2.0 * share * 1.125) - 0.5) / 1.0 END
       END, 6) END AS position
FROM takes
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT row_id, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed
  WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 2
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.first AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row_id
"""

OP12 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b)
  )
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS digits FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT id, run, times, list_transform(range(len(digits) // 2), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)) AS b
  FROM counted
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
  FROM bytes, crc_table
), written AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
              ELSE run END AS word, times
  FROM hashed
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail
  FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)
), pairs AS (
  SELECT a.word AS a, b.word AS b, b.n AS nb FROM cuts a JOIN cuts b ON a.head = b.head AND a.tail = b.tail WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.head || c.tail = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.head || c.tail = w.word
), ranked AS (
  SELECT a, b, nb, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY nb DESC, b) AS place FROM pairs
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN nb >= 5 * n THEN b END AS form, CASE WHEN nb >= 5 * n THEN nb END AS form_n
  FROM words LEFT JOIN ranked ON a = word AND place = 1
), chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM formed f JOIN ends e ON e.word = f.word
"""

OP13 = r"""
WITH clean AS (
  SELECT row_number() OVER () AS row_id, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row_id AS anchor, a.vec_id AS anchor_id, c.row_id AS other, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM clean a JOIN clean c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS place FROM scored WHERE same
), negatives AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor
  WHERE p.place <= 5 AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT CAST(anchor_id AS BIGINT) AS anchor_id, CAST(positive_id AS BIGINT) AS positive_id, CAST(rank AS INTEGER) AS rank,
       CAST(negative_id AS BIGINT) AS negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""

ORACLE: dict[str, str] = {
    "op1_chat_perspectives": OP1, "op8_topk_norm_sorted": OP8, "op9_mix_curriculum": OP9,
    "op11_line_blooms": OP11, "op12_spelling_variants": OP12, "op13_hard_negatives": OP13,
}
