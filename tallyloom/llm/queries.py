"""The registered queries of this subpackage, with the DuckDB statement where SQL can express one."""

from __future__ import annotations

from tallyloom.llm import (
    hard_negatives,
    langid,
    lm,
    mixing,
    near_dedup,
    neighbors,
    packing,
    quality,
    resampling,
    rules,
    secrets,
    substrings,
    toxicity,
)

QUERIES = {
    "op1_near_duplicates": near_dedup.op1_near_duplicates,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_language_id": langid.op5_language_id,
    "op6_source_mix": mixing.op6_source_mix,
    "op7_nearest_vectors": neighbors.op7_nearest_vectors,
    "op8_repeated_passages": substrings.op8_repeated_passages,
    "op9_quality_ledger": quality.op9_quality_ledger,
    "op10_stupid_backoff": lm.op10_stupid_backoff,
    "op11_importance_resampling": resampling.op11_importance_resampling,
    "op12_quality_rules": rules.op12_quality_rules,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = f"words AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents)"
_LOWERED = f"""words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents)"""

_NEAR = f"""WITH RECURSIVE {_LOWERED},
shingles AS (
  SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] AS x FROM words, unnest(range(1, len(ws))) AS u(i)
  UNION ALL SELECT doc_id, ws[1] FROM words WHERE len(ws) = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.b, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(r.b, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a) r USING (doc_id)"""

_REPEATED = f"""WITH {_WORDS},
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + {substrings.WIDTH - 1}], ' ')) AS h
  FROM words, unnest(range(1, len(ws) - {substrings.WIDTH - 2})) AS u(i)),
firsts AS (SELECT h, min(doc_id) AS doc_id FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT w.doc_id, w.i + k AS i FROM windows w JOIN firsts f ON f.h = w.h AND f.doc_id < w.doc_id,
    range({substrings.WIDTH}) AS r(k)),
kept AS (
  SELECT w.doc_id, string_agg(ws[i], ' ' ORDER BY i) AS t FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM words) w
  ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)"""

_QUALITY = f"""WITH {_WORDS},
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS x FROM words, unnest(range(1, len(ws) - 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM words),
measured AS (
  SELECT w.doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(a.n, 0) AS n_repeat_words
  FROM words w JOIN lines USING (doc_id) LEFT JOIN again a USING (doc_id)),
failed AS (SELECT *, CAST({" + ".join(f"CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality.RULES))} AS BIGINT) AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  failed & {quality.mask(quality.BASE_RULES)} <> 0 AS base_failed,
  failed & {quality.mask(quality.POLICIES[quality.PRODUCTION])} = 0 AS kept FROM failed"""

_BACKOFF = f"""WITH {_LOWERED},
places AS (SELECT doc_id, ws, len(ws) AS n_words, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (
  SELECT doc_id, n, i, array_to_string(ws[i - n + 1:i], ' ') AS g FROM places, range(1, {lm.ORDER + 1}) AS r(n) WHERE i >= n),
own AS (SELECT doc_id, n, g, count(*) AS c FROM grams GROUP BY ALL),
total AS (SELECT n, g, sum(c) AS c FROM own GROUP BY ALL),
counted AS (
  SELECT x.doc_id, x.n, x.i, CAST(t.c - o.c AS BIGINT) AS c FROM grams x JOIN own o ON o.doc_id = x.doc_id AND o.n = x.n AND o.g = x.g
  JOIN total t ON t.n = x.n AND t.g = x.g),
corpus AS (SELECT sum(len(ws)) AS c FROM words),
scored AS (
  SELECT c.doc_id, c.i, c.n, c.c / CASE WHEN c.n = 1 THEN (SELECT c FROM corpus) - p.n_words ELSE b.c END AS s
  FROM counted c JOIN places p ON p.doc_id = c.doc_id AND p.i = c.i
  LEFT JOIN counted b ON b.doc_id = c.doc_id AND b.n = c.n - 1 AND b.i = c.i - 1 WHERE c.c > 0),
best AS (SELECT doc_id, i, max(n) AS n, arg_max(s, n) AS s FROM scored GROUP BY ALL),
words_ AS (
  SELECT p.doc_id, least(p.i, {lm.ORDER}) AS top, b.n,
    ln(coalesce(b.s, 1 / ((SELECT c FROM corpus) + 1))) + (least(p.i, {lm.ORDER}) - coalesce(b.n, 1)) * ln({lm.ALPHA}) AS s
  FROM places p LEFT JOIN best b USING (doc_id, i)),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE coalesce(n, 0) < top) AS backed_off, count(*) FILTER (WHERE n IS NULL) AS unseen, sum(s) AS s
  FROM words_ GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(backed_off, 0) AS backed_off, coalesce(unseen, 0) AS unseen,
  round(coalesce(s, 0.0), 3) AS log_score, round(s / nullif(len(ws), 0), 6) AS mean_log_score
FROM words w LEFT JOIN sums USING (doc_id)"""

#: The CRC-32 of each distinct word, byte by byte, from a table made by its rule.
_RESAMPLED = f"""WITH places AS (
  SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY n) AS t FROM range(256) AS r(n)),
ours AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
theirs AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
used AS (SELECT doc_id, unnest(ws) AS w FROM ours),
spelled AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM used UNION SELECT w FROM theirs)),
hashed AS (
  SELECT w, xor(list_reduce([4294967295] || list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {resampling.BUCKETS} AS bucket FROM spelled, places),
s AS (SELECT bucket, count(*) AS n FROM used JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM theirs JOIN hashed USING (w) GROUP BY bucket),
gain AS (
  SELECT h.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (a.n + {resampling.BUCKETS})
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (b.n + {resampling.BUCKETS})))) AS BIGINT) AS g
  FROM (SELECT DISTINCT bucket FROM hashed) h LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket),
    (SELECT count(*) AS n FROM used) a, (SELECT count(*) AS n FROM theirs) b),
weighed AS (
  SELECT o.doc_id, len(ws) AS n_features, coalesce(m.weight, 0) AS weight,
    (CAST('0x' || sha256('{resampling.SEED}:' || coalesce(CAST(o.doc_id AS VARCHAR), ''))[:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296 AS u
  FROM ours o LEFT JOIN (
    SELECT doc_id, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM used JOIN hashed USING (w) JOIN gain USING (bucket)
    GROUP BY doc_id) m ON m.doc_id IS NOT DISTINCT FROM o.doc_id),
scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) AS score FROM weighed),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () * {resampling.PERCENT} // 100 AS quota
  FROM scored WHERE n_features >= {resampling.LEAST_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= quota THEN r END AS rank FROM scored s LEFT JOIN drawn USING (doc_id)"""

_NEGATIVES = f"""WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor, other, score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= {hard_negatives.POSITIVES}),
fitting AS (
  SELECT p.anchor, p.other AS positive, n.other AS negative, p.score AS high, n.score AS low,
    row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS rank
  FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
    AND {hard_negatives.LOW} * p.score <= 100 * n.score AND 100 * n.score <= {hard_negatives.HIGH} * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, negative AS negative_id, high AS positive_score,
  low AS negative_score FROM fitting WHERE rank <= {hard_negatives.NEGATIVES}"""

ORACLES = {
    "op1_near_duplicates": _NEAR,
    "op8_repeated_passages": _REPEATED,
    "op9_quality_ledger": _QUALITY,
    "op10_stupid_backoff": _BACKOFF,
    "op11_importance_resampling": _RESAMPLED,
    "op13_hard_negatives": _NEGATIVES,
}
