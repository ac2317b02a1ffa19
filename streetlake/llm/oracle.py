"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

from streetlake.llm.secrets import BASE, RULES

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.rid, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.rid <> b.rid AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN (SELECT lang, term FROM k) USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n + v.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (v.n + v.v) AS q
  FROM s JOIN v ON s.lang = v.lang JOIN k ON s.lang = k.lang
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
x AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS n FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(n AS INTEGER) AS rank
FROM o WHERE part = 'pair' OR n <= 200
"""


def _secrets() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = ", ".join(f"({quote(kind)}, {k}, {quote(pattern)}, {group}, {least})"
                      for k, (kind, pattern, group, least) in enumerate(RULES))
    spans = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, ord)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
k(kind, ord, pat, grp, least) AS (VALUES {kinds}),
p AS (
  SELECT rid, kind, ord, pat, grp, least,
         string_split(regexp_replace(t, pat, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts FROM d, k),
u AS (SELECT * EXCLUDE parts, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM p WHERE len(parts) > 1),
s AS (SELECT *, CAST(sum(length(part)) OVER (PARTITION BY rid, ord ORDER BY i) AS BIGINT) AS e FROM u),
f AS (
  SELECT rid, kind, ord, e - length(part) AS b, e FROM s
  WHERE i % 2 = 0 AND length(CASE WHEN grp = 2 THEN regexp_extract(part, pat, 2) ELSE part END) >= least),
a AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, {spans} FILTER (ord < {len(BASE)}) AS base, {spans} AS spans
  FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_secret_scan": _secrets(), "op4_exact_top_k": TOP_K,
            "op12_source_divergence": DIVERGENCE}
