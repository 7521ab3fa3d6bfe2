"""The corpus queries that SQL can express, for comparison in another engine."""

from __future__ import annotations

import re

from sluiceway.llm.chat_format import Template
from sluiceway.llm.common import LOWER, TOKEN, UPPER, WORD

_LOWER = f"translate(text, '{UPPER}', '{LOWER}')"
_SIZED = f"""
  SELECT doc_id, source, coalesce(md5(text), '-') AS text_id, CAST(coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS BIGINT) AS size
  FROM documents"""

DECONTAMINATION = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(regexp_extract_all({_LOWER}, '{WORD}'), []) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) ELSE [w] END) AS g
  FROM items WHERE len(w) > 0
), windows AS (
  SELECT rid, n, i, w[i:i + n - 1] AS g
  FROM docs, (SELECT DISTINCT len(g) AS n FROM grams), unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (
  SELECT rid, n, i, item_id FROM windows JOIN grams USING (g)
), found AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY rid
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, n, i FROM hits), unnest(range(i, i + n)) AS t(p) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN found USING (rid) LEFT JOIN covered USING (rid)"""

MIXING = f"""
WITH sized AS ({_SIZED}
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(place - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap FROM sources
), levels AS (
  SELECT *, row_number() OVER w AS turn,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM sources)
          - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)
), opened AS (SELECT min(turn) AS turn, arg_min(level, turn) AS level FROM levels WHERE cap > weight * level
), targets AS (
  SELECT source, source_size, CASE WHEN o.turn IS NULL OR l.turn < o.turn THEN cap ELSE weight * o.level END AS target
  FROM levels l LEFT JOIN opened o ON true
), placed AS (
  SELECT s.*, t.source_size, t.target,
         CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY
           substr(md5(concat('0:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', text_id)), 1, 15), doc_id, text_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS times FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(size * times + least(greatest(CAST(floor(target) AS BIGINT) - times * source_size - before, 0), size) AS BIGINT) AS taken
FROM passes"""

_REACHED = """, both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS least FROM reached GROUP BY a)"""

EMBEDDINGS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98
){_REACHED}, counted AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(s.least, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(s.least, e.vec_id) AS kept
FROM embeddings e LEFT JOIN smallest s ON e.vec_id = s.a LEFT JOIN counted c ON e.vec_id = c.a"""

JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{TOKEN}'), []) AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]))
                      WHEN len(w) > 0 THEN [w] ELSE [] END AS s FROM docs
), shingles AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k, any_value(x.n) + any_value(y.n) AS sizes
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM shared WHERE 100 * k >= 85 * (sizes - k)
){_REACHED}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id
FROM sets LEFT JOIN smallest ON doc_id = a"""

FILTER_AUDIT = f"""
WITH seen AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '{TOKEN}'), []) AS w FROM documents
), earliest AS (SELECT t, min(doc_id) AS first FROM seen GROUP BY t
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
           + 4 * CAST(100 * (length(t) - length(translate(t, '{UPPER}', ''))) > 2 * length(t) AS INT)
           + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS mask,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM seen JOIN earliest USING (t) LEFT JOIN marks USING (doc_id)
), cells AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, CAST(k AS INT) AS step, bits[k] AS bit, CAST(list_sum(bits[1:k]) - bits[k] AS INT) AS earlier FROM orders, range(1, 6) AS t(k)
), counted AS (
  SELECT part, filter_order, step, bit,
         sum(n * CAST(mask & (earlier | bit) = 0 AS INT)) AS kept,
         sum(n * CAST(mask & bit <> 0 AND mask & earlier = 0 AS INT)) AS removed,
         sum(n * CAST(mask & bit <> 0 AND mask & earlier <> 0 AS INT)) AS redundant,
         sum(n * CAST(mask = bit AS INT)) AS unique_fails,
         sum(n * good * CAST(mask & bit <> 0 AND mask & earlier = 0 AS INT)) AS good_lost,
         sum(n * toxic * CAST(mask & bit <> 0 AND mask & earlier = 0 AS INT)) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted"""

_CONTROLS = Template().controls()
_HIDDEN = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in _CONTROLS)
_MARKS = " ".join(f"WHEN '{role}' THEN {len(mark)}" for role, mark in Template().marks)
CHAT_FORMAT = f"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given
), written AS (
  SELECT *, md5(role || chr(10) || text) AS tie, length(text) + len(regexp_extract_all(text, '{_HIDDEN}')) + {len(_CONTROLS[1])}
         + CASE role {_MARKS} ELSE {len(_CONTROLS[-2]) + len(_CONTROLS[-1])} + length(role) + len(regexp_extract_all(role, '{_HIDDEN}')) END AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, tie)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, tie) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) + {len(_CONTROLS[0])} AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents
), split AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces
), counted AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, lang || chr(9) || phrase AS key, count(*) AS a
  FROM split, (SELECT unnest([1, 2, 3]) AS m) AS sizes, unnest(range(1, len(w) - m + 2)) AS t(i) GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND a >= 10
), cuts AS MATERIALIZED (
  SELECT lang, m, phrase, a, w, 1 AS k, lang || chr(9) || w[1] AS first, lang || chr(9) || array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, m, phrase, a, w, 2, lang || chr(9) || array_to_string(w[1:2], ' '), lang || chr(9) || w[3] FROM candidates WHERE m = 3
), scored AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.w, k, x.a AS l, y.a AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.key = c.first JOIN counted y ON y.key = c.rest
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, part AS phrase, max(a) AS more FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM candidates WHERE m = 3) GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase WHERE g.more IS NULL OR 100 * g.more < 50 * s.a
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

LLM_ORACLE = {"op11_chat_format": CHAT_FORMAT, "op13_collocations": COLLOCATIONS, "op12_filter_audit": FILTER_AUDIT, "op1_decontamination": DECONTAMINATION, "op4_mixing": MIXING, "op6_embedding_links": EMBEDDINGS, "op10_jaccard_join": JACCARD}
