"""SQL that states the results of the queries that SQL can express, in DuckDB's dialect over the given tables."""

from __future__ import annotations

from tidegate.llm import line_chunks, mixing, projection_forest, quality_rules

SPACE = r"[\x20\x09-\x0D]+"
WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"
HAS_WORD = r"regexp_matches({}, '[^\x20\x09-\x0D]')"

_LINKED = f"""SELECT a.vec_id, b.vec_id AS other FROM usable a JOIN usable b ON a.label = b.label AND a.row <> b.row AND len(a.v) = len(b.v)
    AND list_cosine_similarity(a.v, b.v) >= {projection_forest.COSINE}"""

OP1 = f"""WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS ({_LINKED}),
reach(vec_id, other) AS (SELECT vec_id, other FROM links UNION SELECT r.vec_id, l.other FROM reach r JOIN links l ON r.other = l.vec_id),
least AS (SELECT vec_id, min(other) AS other FROM reach GROUP BY vec_id),
counts AS (SELECT vec_id, count(*) AS n FROM links GROUP BY vec_id)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.other, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.other, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c USING (vec_id) LEFT JOIN least l USING (vec_id)"""

OP6 = f"""WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce('t' || text, '') AS same, coalesce(text, '') AS t, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {HAS_WORD.format("x")}) AS lines FROM documents),
windows AS (SELECT row, i, [w[i], w[i + 1], w[i + 2]] AS three FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, three) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY row),
line AS (SELECT row, source, same, unnest(lines) AS line FROM d),
normal AS (SELECT row, source, same, lower(trim(regexp_replace(line, '{SPACE}', ' ', 'g'))) AS line FROM line),
hosts AS (SELECT source, count(DISTINCT same) AS texts FROM d GROUP BY source),
common AS (SELECT n.source, n.line FROM normal n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source GROUP BY n.source, n.line, h.texts
  HAVING count(DISTINCT n.same) > {quality_rules.LIMIT_TEXTS} AND count(DISTINCT n.same) > {quality_rules.LIMIT_SHARE} * h.texts),
lost AS (SELECT n.row, sum(len(string_split(n.line, ' '))) AS n, list_sort(list(DISTINCT n.line)) AS lost_lines FROM normal n
  JOIN common c ON n.source IS NOT DISTINCT FROM c.source AND n.line = c.line GROUP BY n.row),
counts AS (SELECT d.doc_id, source, lost_lines, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(l.n, 0) AS BIGINT) AS n_common_words FROM d LEFT JOIN repeated r USING (row) LEFT JOIN lost l USING (row)),
judged AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  n_common_words > 0 AND n_words - n_common_words < {quality_rules.MIN_WORDS} AS little,
  n_common_words > 0 AND 100 * (n_words - n_common_words) < {quality_rules.MIN_LEFT_PERCENT} * n_words AS mostly FROM counts),
grouped AS (SELECT *, coalesce(doc_id, {quality_rules.LAST}) AS doc,
  min(CASE WHEN mostly AND NOT base_failed THEN coalesce(doc_id, {quality_rules.LAST}) END) OVER (PARTITION BY source, mostly, lost_lines) AS first FROM judged)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (NOT little AND NOT mostly OR mostly AND doc = first) AS kept, n_common_words FROM grouped"""

OP7 = f"""WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '-')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST({list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight FROM s),
f AS (SELECT *, {mixing.SHARE} * sum(CAST(source_size AS DOUBLE)) OVER () AS budget, sum(weight) OVER () AS everything,
  {mixing.MAX_EPOCHS} * coalesce(sum(CAST(source_size AS DOUBLE)) OVER o, 0) AS filled, coalesce(sum(weight) OVER o, 0) AS gone FROM w
  WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((budget - filled) / (everything - gone), source_size / weight) AS level FROM f
  WHERE (budget - filled) / (everything - gone) * weight <= {mixing.MAX_EPOCHS} * CAST(source_size AS DOUBLE)),
t AS (SELECT source, source_size, least({mixing.MAX_EPOCHS} * CAST(source_size AS DOUBLE),
  coalesce(level * weight, {mixing.MAX_EPOCHS} * CAST(source_size AS DOUBLE))) AS target FROM f, l),
o AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
e AS (SELECT o.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken FROM e"""

_ROLLED = " + ".join(
    f"CASE WHEN i > {k} THEN CAST('0x' || substr(md5(l[i - {k}]), 1, 8) AS BIGINT) ELSE 0 END * {pow(line_chunks.FACTOR, k, line_chunks.MODULUS) % 65_521}"
    for k in range(line_chunks.WINDOW)
)
OP9 = f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT row, doc_id, i, l[i] AS line, CASE WHEN ({_ROLLED}) % {line_chunks.MODULUS} % {line_chunks.DIVISOR} = 0 THEN 1 ELSE 0 END AS ends
  FROM (SELECT row, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
placed AS (SELECT *, coalesce(sum(ends) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM lines),
chunks AS (SELECT row, doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS bytes, count(*) AS n FROM placed GROUP BY row, doc_id, chunk),
judged AS (SELECT *, n >= {line_chunks.MIN_LINES} AND {HAS_WORD.format("bytes")} AND row_number() OVER (PARTITION BY bytes ORDER BY doc_id, chunk) > 1 AS gone
  FROM chunks)
SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks, CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_removed_lines,
  sha256(coalesce(string_agg(bytes, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256 FROM judged GROUP BY row, doc_id"""

ORACLES = {"op1_projection_forest": OP1, "op6_quality_rules": OP6, "op7_source_mix": OP7, "op9_line_chunks": OP9}
