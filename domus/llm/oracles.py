"""DuckDB SQL for the operators whose whole result SQL can express, and for the
base part of the scans (their queries are ``base_secrets`` and ``base_licenses``)."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SPACE = r"'[^\x20\x09-\x0D]+'"

TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) AND len(embedding) > 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

#: word windows are compared as text; holds where doc_ids do not repeat
SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACE}) AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)
), least AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k
), hit AS (SELECT doc_id, list(i) AS starts FROM win JOIN least USING (k) WHERE first < doc_id GROUP BY doc_id
), gone AS (
  SELECT doc_id, list_distinct(flatten([range(s, s + 13) FOR s IN starts])) AS gone FROM hit
), flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w
), off AS (SELECT doc_id, unnest(gone) AS i FROM gone
), kept AS (
  SELECT f.doc_id, count(o.i) AS n_removed, string_agg(CASE WHEN o.i IS NULL THEN word END, ' ' ORDER BY f.i) AS kept
  FROM flat f LEFT JOIN off o ON f.doc_id = o.doc_id AND f.i = o.i GROUP BY f.doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents
), b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark
), pat AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0))
), win AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT doc_id, w, m FROM d, (SELECT DISTINCT m FROM pat) WHERE len(w) >= m))
), hit AS (SELECT doc_id, win.m, i, item_id FROM win JOIN pat USING (m, k)
), words AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS x FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: shingles are compared as text; links go through shared shingles
JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACE}) AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y WHERE 100 * common.n >= 90 * (s.n + t.n - common.n)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x
), comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM w LEFT JOIN size USING (doc_id) JOIN comp USING (doc_id)
"""


def _spans(kind: str, pattern: str, group: int, least: int) -> str:
    """(doc_id, kind, start, end) of a pattern's leftmost matches: the text
    between matches and the matches before one give its place."""
    return f"""
  SELECT doc_id, '{kind[2:]}' AS kind, {kind[0]} AS place, start, start + length(m) AS stop FROM (
    SELECT doc_id, unnest(m) AS m, unnest(v) AS v, unnest([CAST(list_sum([length(b) FOR b IN between_[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS BIGINT)
                                                            FOR i IN range(1, len(m) + 1)]) AS start
    FROM (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS between_, regexp_extract_all(text, '{pattern}') AS m,
                 regexp_extract_all(text, '{pattern}', {group}) AS v FROM t))
  WHERE length(v) >= {least}"""


# fixed values: the base patterns of the contract
_ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRETS = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents
), spans AS ({_spans("0:assign", _ASSIGN, 1, 6)}
  UNION ALL {_spans("1:access", "AKIA[A-Z0-9]+", 0, 20)}
  UNION ALL {_spans("2:hex", "[0-9a-f]+", 0, 24)}
), agg AS (
  SELECT doc_id, count(CASE WHEN place = 0 THEN 1 END) AS n_assign, count(CASE WHEN place = 1 THEN 1 END) AS n_access, count(CASE WHEN place = 2 THEN 1 END) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256
FROM t LEFT JOIN agg USING (doc_id)
"""

LICENSES = f"""
WITH t AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents
), places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t
), hit AS (
  SELECT doc_id, i - 1 AS start, CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit' WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
         WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END AS label FROM places
), agg AS (
  SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM hit WHERE label IS NOT NULL GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels
FROM t LEFT JOIN agg USING (doc_id)
"""
