"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_HOST = "translate(CASE WHEN contains(coalesce({u}, ''), '://') THEN regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*') ELSE '' END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "CASE WHEN contains(coalesce({u}, ''), '://') THEN regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
_IDENTITY = (
    "CASE WHEN contains({u}, '://') THEN translate(regexp_extract({u}, '^([^:/?#]*)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '://' || "
    + _HOST
    + " || regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*([^#]*)', 1) END"
)


def _rule(host: str, path: str) -> str:
    fits = lambda h, p: f"(({host}) = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}')"
    cases = [("www.example.com", "/en/"), ("example.com", "/en/"), ("net", "/es/"), ("net", "/fr/"), ("com", "/")]
    return "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p in cases) + " END"


_VERDICT = "CASE {r} WHEN 'www.example.com/en/' THEN 'allow' WHEN 'com/' THEN 'allow' WHEN 'example.com/en/' THEN 'block' WHEN 'net/es/' THEN 'block' WHEN 'net/fr/' THEN 'block' END"

OP8 = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages
  WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')
), hrefs AS (
  SELECT url, trim(CASE
    WHEN regexp_matches(tag, '(?i)^<link\\b') AND regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b')
      THEN regexp_extract(tag, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]*)', 1)
    WHEN regexp_matches(tag, '(?i)^<meta\\b') AND regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')
      THEN regexp_extract(tag, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]*)', 1) END) AS href,
    regexp_extract(url, '^([^:/?#]*)://', 1) AS scheme,
    regexp_extract(url, '^[^:/?#]*://[^/?#]*') AS site, {_PATH.format(u="url")} AS path FROM tags
), targets AS (
  SELECT url, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN href
    WHEN href = '' OR starts_with(href, '#') THEN NULL
    WHEN starts_with(href, '//') THEN scheme || ':' || href
    WHEN starts_with(href, '/') THEN site || href
    WHEN starts_with(href, '?') THEN site || path || href
    ELSE site || CASE WHEN regexp_extract(path, '^(.*/)?') = '' THEN '/' ELSE regexp_extract(path, '^(.*/)?') END || href END AS target
  FROM hrefs WHERE href IS NOT NULL
), edges AS (
  SELECT {_IDENTITY.format(u="url")} AS a, {_IDENTITY.format(u="target")} AS b FROM targets WHERE target IS NOT NULL
), sym AS (SELECT a, b FROM edges WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b UNION SELECT b, a FROM edges WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b),
reach AS (SELECT DISTINCT a AS node, a AS root FROM sym UNION SELECT s.b, r.root FROM reach r JOIN sym s ON r.node = s.a),
comp AS (SELECT node, min(root) AS component FROM reach GROUP BY 1),
ruled AS (SELECT node, component, {_rule(_HOST.format(u="node"), _PATH.format(u="node"))} AS rule FROM comp),
decided AS (SELECT component FROM (SELECT component, {_VERDICT.format(r="rule")} AS v FROM ruled) GROUP BY 1 HAVING bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), false)),
blocked AS (SELECT node FROM ruled WHERE component IN (SELECT component FROM decided)),
judged AS (SELECT page_id, url, {_HOST.format(u="url")} AS host, {_PATH.format(u="url")} AS path FROM pages),
own AS (SELECT *, {_rule("host", "path")} AS rule FROM judged)
SELECT page_id, host, path, rule,
  coalesce({_VERDICT.format(r="rule")}, CASE WHEN {_IDENTITY.format(u="url")} IN (SELECT node FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM own
"""


_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"

OP3 = f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_USABLE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP9 = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a),
comp AS (SELECT node, min(root) AS component FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN comp ON node = vec_id LEFT JOIN n ON n.a = vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_vector_search": OP3, "op8_url_filter": OP8, "op9_vector_dedup": OP9}
