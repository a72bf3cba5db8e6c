"""DuckDB SQL for the operators that SQL can express, written from the
contracts. The others are tested against brute-force versions in tests/llm."""

OP10 = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS iv FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.iv, c.iv)::BIGINT AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight FROM s
), r AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS ratio FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM r
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM l
), p AS (
  SELECT d.*, source_size, target, floor(target)::BIGINT AS take,
    (sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  greatest(0, least(size, take - start)) + greatest(0, least(size, take - source_size - start)) AS taken
FROM p
"""

_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _shape(x: str) -> str:
    return f"regexp_replace(translate({x}, {_UP}, {_LOW}), '[0-9]+', '#', 'g')"


OP6 = f"""
WITH RECURSIVE u AS (
  SELECT row_number() OVER () AS n, page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_UP}, {_LOW}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), k AS (
  SELECT *, list_distinct(list_concat(
      list_concat(CASE WHEN instr(url, '://') > 0 AND split_part(url, '://', 1) <> '' THEN ['s:' || split_part({_shape('url')}, '://', 1)] ELSE [] END,
                  ['h:' || x FOR x IN string_split({_shape('host')}, '.') IF x <> '']),
      list_concat(['p:' || x FOR x IN string_split({_shape('path')}, '/') IF x <> ''],
                  ['q:' || split_part(x, '=', 1) FOR x IN string_split({_shape("regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1)")}, '&') IF split_part(x, '=', 1) <> '']))) AS tokens,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM h
), e AS (
  SELECT n, tokens, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS label FROM k WHERE rule IS NOT NULL
), x AS (
  SELECT n, label, unnest(tokens) AS t FROM e
), a AS (
  SELECT n, label, [t] AS a FROM x UNION ALL SELECT x.n, x.label, list_append(a.a, x.t) FROM a JOIN x ON x.n = a.n AND x.t > a.a[-1]
), c AS (
  SELECT a, label, count(*) AS both_n, sum(count(*)) OVER (PARTITION BY a) AS all_n FROM a GROUP BY a, label
), g AS (
  SELECT a, label, both_n / all_n::DOUBLE AS conf, both_n FROM c
  WHERE both_n >= ceil(0.02::DOUBLE * (SELECT count(*) FROM e)) AND both_n / all_n::DOUBLE >= 0.8
), rules AS (
  SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM g s WHERE len(s.a) < len(g.a) AND list_has_all(g.a, s.a) AND s.label = g.label AND s.conf >= g.conf)
), m AS (
  SELECT k.n, r.label, r.a, row_number() OVER (PARTITION BY k.n ORDER BY conf DESC, both_n DESC, label <> 'block', a) AS place
  FROM k JOIN rules r ON list_has_all(k.tokens, r.a) WHERE k.rule IS NULL
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE coalesce(label, 'allow') END AS verdict,
  array_to_string(a, ' ') AS mined
FROM k LEFT JOIN (SELECT * FROM m WHERE place = 1) b ON k.n = b.n
"""


def _leaf(n_chars: str) -> str:
    fields = [f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')" for x in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(fields)})"


def _levels(name: str, leaves: str) -> str:
    return f"""{name} AS (
  SELECT tree, 0 AS level, i, h FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM {name}) WHERE m > 1 GROUP BY tree, level + 1, i // 2
)"""


def _fold(name: str, start: str, nodes: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT n, f.tree, f.level + 1, f.i // 2,
    CASE WHEN u.h IS NULL THEN sha256(node) WHEN u.i < f.i THEN sha256(u.h || node) ELSE sha256(node || u.h) END, proof || coalesce(u.h, ''), leaf
  FROM {name} f JOIN {nodes}_top t ON t.tree = f.tree LEFT JOIN {nodes} u ON u.tree = f.tree AND u.level = f.level AND u.i = xor(f.i, 1)
  WHERE f.level < t.level
)"""


OP13 = f"""
WITH RECURSIVE bits AS (
  SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), tab AS (
  SELECT list(c ORDER BY i) AS v FROM bits WHERE k = 8
), crc AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295 AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL SELECT doc_id, s, k + 1, xor(c >> 8, v[(xor(c, ord(s[k + 1])) & 255) + 1]) FROM crc, tab WHERE k < length(s)
), bad AS (
  SELECT doc_id FROM crc WHERE k = length(s) AND xor(c, 4294967295) % 7 = 0
), rows AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS h, {_leaf("(n_chars + 1)")} AS changed FROM documents
), leaves AS (
  SELECT row_number() OVER () AS n, r.doc_id, tree, h, CASE WHEN bad.doc_id IS NULL THEN h ELSE changed END AS forged,
    row_number() OVER (PARTITION BY tree ORDER BY r.doc_id NULLS FIRST, h) - 1 AS i
  FROM rows r LEFT JOIN bad ON r.doc_id = bad.doc_id
), {_levels("low", "leaves")}, low_top AS (
  SELECT tree, max(level) AS level, arg_max(h, level) AS h FROM low GROUP BY tree
), subroots AS (
  SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM low_top
), {_levels("high", "subroots")}, high_top AS (
  SELECT tree, max(level) AS level, arg_max(h, level) AS h FROM high GROUP BY tree
), {_fold("a", "SELECT n, tree, 0 AS level, i, forged AS node, '' AS proof, h AS leaf FROM leaves", "low")},
{_fold("b", "SELECT n, '' AS tree, 0 AS level, s.i, node, proof, s.name AS leaf FROM a JOIN low_top t ON a.tree = t.tree AND a.level = t.level JOIN subroots s ON s.name = a.tree", "high")}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(b.proof) AS proof_sha256, b.node AS folded_root, b.node = t.h AS verified
FROM b JOIN high_top t ON b.level = t.level JOIN leaves l ON l.n = b.n JOIN subroots s ON s.name = l.tree
"""
