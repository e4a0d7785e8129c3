"""SQL that gives the rows of queries without signatures, models or compression."""

from __future__ import annotations

from leadgrade.llm import cascade, clusters, negatives, top_k
from leadgrade.llm.decontaminate import CONTAINMENT
from leadgrade.llm.line_dedup import DIGITS_SHARE, FIXED_SHARE, MIN_FIXED, MIN_TEXTS
from leadgrade.llm.words import WORD_PATTERN

_SHINGLES = "unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"

#: Every item against every document: the share of its five-word shingles.
DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_PATTERN}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(lower(text), '{WORD_PATTERN}') AS w FROM benchmark),
doc_shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, {_SHINGLES} AS s FROM docs)),
item_shingles AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, {_SHINGLES} AS s FROM items)),
sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id),
found AS (
  SELECT doc_id, item_id, count(*) AS k FROM doc_shingles JOIN item_shingles USING (s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(k AS DOUBLE) / n AS containment FROM found JOIN sizes USING (item_id)
WHERE CAST(k AS DOUBLE) / n >= {CONTAINMENT}"""

#: The template tree over whole tables.
LINE_DEDUP = f"""
WITH texts AS (SELECT DISTINCT md5(text) AS k, string_split(text, chr(10)) AS raws FROM documents
  WHERE text IS NOT NULL),
raw_lines AS (SELECT k, unnest(raws) AS raw, unnest(range(len(raws))) AS line_no FROM texts),
lines AS (
  SELECT k, line_no, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line FROM (
    SELECT k, line_no, trim(regexp_replace(raw, '[ \\t\\x0B\\f\\r]+', ' ', 'g')) AS line FROM raw_lines)
  WHERE line <> ''),
placed AS (
  SELECT k, line_no, line, concat_ws(' ', len(t), t[1], t[2]) AS leaf
  FROM (SELECT *, string_split(line, ' ') AS t FROM lines)),
known AS (SELECT leaf, line, count(DISTINCT k) AS n FROM placed GROUP BY leaf, line),
tokens AS (
  SELECT leaf, line, n, unnest(t) AS token, unnest(range(len(t))) AS place
  FROM (SELECT *, string_split(line, ' ') AS t FROM known)),
sizes AS (SELECT leaf, count(*) AS m FROM known GROUP BY leaf),
fixed AS (
  SELECT leaf, place, token FROM tokens JOIN sizes USING (leaf) WHERE token <> '<*>'
  GROUP BY leaf, place, token, m HAVING 2 * count(*) > m),
general AS (
  SELECT t.leaf, t.line, any_value(t.n) AS n, count(*) AS size, count(f.token) AS n_fixed,
    count(*) FILTER (WHERE t.token <> '<*>') AS n_plain,
    string_agg(coalesce(f.token, '<*>'), ' ' ORDER BY t.place) AS template
  FROM tokens t LEFT JOIN fixed f ON f.leaf = t.leaf AND f.place = t.place AND f.token = t.token
  GROUP BY t.leaf, t.line),
judged AS (
  SELECT *, n >= {MIN_TEXTS} AND (n_plain = size
    OR (n_plain >= {MIN_FIXED} AND n_plain >= {DIGITS_SHARE} * size)) AS as_it_is FROM general),
templates AS (
  SELECT leaf, line, as_it_is, CASE WHEN as_it_is THEN line ELSE template END AS template FROM judged
  WHERE as_it_is OR (n_fixed >= {MIN_FIXED} AND n_fixed >= {FIXED_SHARE} * size)),
named AS (SELECT k, line_no, leaf, as_it_is, template FROM placed JOIN templates USING (leaf, line)),
often AS (SELECT leaf, as_it_is, template FROM named GROUP BY ALL HAVING count(DISTINCT k) >= {MIN_TEXTS}),
gone AS (SELECT k, line_no, 1 AS gone FROM named JOIN often USING (leaf, as_it_is, template)),
left_over AS (
  SELECT k, coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (WHERE gone IS NULL), '') AS text,
    count(*) AS n_lines, count(gone) AS n_dropped
  FROM raw_lines LEFT JOIN gone USING (k, line_no) GROUP BY k)
SELECT doc_id, l.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN left_over l ON l.k = md5(d.text)"""


_USABLE = """embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"""

#: Every anchor against every row.
HARD_NEGATIVES = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({negatives.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM kept a JOIN kept c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES}),
ranked AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND {negatives.LOW} * positive_score <= 100 * score
    AND 100 * score <= {negatives.HIGH} * positive_score)
SELECT * FROM ranked WHERE rank <= {negatives.NEGATIVES}"""


#: Every query against every row.
TOP_K = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({top_k.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM kept q JOIN kept c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= {top_k.TOP}"""


def clustering() -> str:
    """All distances in each round, and sums by cluster and component between rounds."""
    k, key = clusters.CENTROIDS, f"sha256('{clusters.SEED}:' || CAST(vec_id AS VARCHAR))"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({clusters.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {clusters.DIM} AND {_USABLE}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY {key}) - 1 AS cluster, v AS m FROM kept ORDER BY {key} LIMIT {k})"""
    ]
    for i in range(clusters.ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, min(list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) * {k}
    + cluster) AS best FROM kept, c{i} GROUP BY r)"""
        )
        if i < clusters.ROUNDS:
            steps.append(
                f"""s{i} AS (
  SELECT best % {k} AS cluster, place, sum(x) AS x, count(*) AS n FROM (
    SELECT best, unnest(v) AS x, unnest(range(len(v))) AS place FROM kept JOIN a{i} USING (r)) GROUP BY ALL),
m{i} AS (
  SELECT cluster, list((x - ((x % n) + n) % n) // n ORDER BY place) AS m FROM s{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, CAST(coalesce(n.m, c.m) AS BIGINT[]) AS m FROM c{i} c LEFT JOIN m{i} n USING (cluster))"""
            )
    last = clusters.ROUNDS
    return f"""WITH {", ".join(steps)},
found AS (SELECT vec_id, best % {k} AS cluster, CAST(best // {k} AS BIGINT) AS distance FROM kept JOIN a{last} USING (r))
SELECT vec_id, CAST(cluster AS INT) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM found JOIN c{last} USING (cluster)"""


def quality_rules() -> str:
    """All measures and all rules of every document."""
    size = cascade.WINDOW
    rules = " OR ".join(f"({r.sql})" for r in cascade.RULES)
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
worded AS MATERIALIZED (
  SELECT *, {cascade._WORDS} AS words, {cascade._WORDED} AS lines FROM docs),
runs AS (
  SELECT r, place, count(*) OVER (PARTITION BY r, run) AS n FROM (
    SELECT r, unnest(range(1, len(words) - {size - 2})) AS place,
      unnest(list_transform(range(1, len(words) - {size - 2}),
        lambda i: array_to_string(words[i:i + {size - 1}], ' '))) AS run FROM worded)),
repeated AS (
  SELECT r, count(DISTINCT place + step) AS n FROM (
    SELECT r, place, unnest(range({size})) AS step FROM runs WHERE n > 1) GROUP BY r),
measured AS (
  SELECT doc_id, text, words, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM worded LEFT JOIN repeated USING (r)),
based AS (
  SELECT *, n_words < {cascade.LEAST_WORDS}
    OR 100 * n_repeat_words > {cascade.MOST_REPEATED} * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({rules}) AS kept FROM based"""


CLUSTERING = clustering()
QUALITY_RULES = quality_rules()
