"""ANSI SQL for the operators that SQL can express; one engine runs it on the same tables."""

from __future__ import annotations

SPACES = r"[\x20\x09-\x0D]+"

EXACT_DEDUP = rf"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)]) END AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), r AS (
  SELECT doc_id, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id
), k AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN k USING (doc_id)
"""


def _level(k: int, weight: str) -> str:
    """Shares of the nodes of one level: full ones get their capacity, the others split what these leave by weight."""
    names = ["domain", "lang", "source"][: k + 1]
    keys, parent = ", ".join(names), ", ".join(names[:-1]) or "TRUE"
    up = " AND ".join(f"u.{c} IS NOT DISTINCT FROM n.{c}" for c in names[:-1])
    budget = "(SELECT CAST(SUM(tokens) AS BIGINT) * 50 // 100 FROM d)" if k == 0 else f"(SELECT share FROM s{k - 1} u WHERE {up})"
    order = f"PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN cap / CAST(weight AS DOUBLE) END NULLS LAST, {names[-1]} NULLS FIRST"
    before = f"OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
n{k} AS (SELECT {keys}, cap, {weight} AS weight, {budget} AS budget FROM (SELECT {keys}, CAST(SUM(cap) AS HUGEINT) AS cap FROM leaf GROUP BY ALL) n),
r{k} AS (SELECT *, ROW_NUMBER() OVER ({order}) AS nth,
  GREATEST(budget - COALESCE(SUM(CASE WHEN weight > 0 THEN cap END) {before}, 0), 0) AS rest,
  SUM(weight) OVER (PARTITION BY {parent}) - COALESCE(SUM(weight) {before}, 0) AS among FROM n{k}),
e{k} AS (SELECT *, MIN(CASE WHEN weight > 0 AND cap * among > rest * weight THEN nth END) OVER (PARTITION BY {parent}) AS cut FROM r{k}),
s{k} AS (SELECT {keys}, CAST(CASE WHEN weight = 0 THEN 0 WHEN cut IS NULL OR nth < cut THEN cap
  ELSE MAX(CASE WHEN nth = cut THEN rest END) OVER (PARTITION BY {parent}) * weight
    // MAX(CASE WHEN nth = cut THEN among END) OVER (PARTITION BY {parent}) END AS BIGINT) AS share FROM e{k})"""


def _mixing() -> str:
    domain = "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END"
    lang = "CASE WHEN domain IS NULL THEN 1 WHEN lang = 'en' THEN 5 WHEN lang IN ('de', 'fr') THEN 2 ELSE 1 END"
    return rf"""
WITH d AS (SELECT doc_id, 'domain' || (TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4) AS domain, lang, source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, SUM(tokens) AS tokens, 4 * SUM(tokens) AS cap FROM d GROUP BY ALL),
{_level(0, domain)}, {_level(1, lang)}, {_level(2, "1")},
plan AS (SELECT l.domain, l.lang, l.source, CASE WHEN l.tokens = 0 THEN CAST(s.share > 0 AS BIGINT) ELSE s.share // CAST(l.tokens AS BIGINT) END AS whole,
  CASE WHEN l.tokens = 0 THEN 0 ELSE s.share % CAST(l.tokens AS BIGINT) END AS part FROM leaf l JOIN s2 s
  ON s.domain IS NOT DISTINCT FROM l.domain AND s.lang IS NOT DISTINCT FROM l.lang AND s.source IS NOT DISTINCT FROM l.source),
o AS (SELECT d.*, whole, part, CAST(('0x' || substr(md5('17:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS place
  FROM d JOIN plan p ON p.domain IS NOT DISTINCT FROM d.domain AND p.lang IS NOT DISTINCT FROM d.lang AND p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, domain, lang, source, tokens, whole + CAST(part > 0 AND SUM(tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY place, doc_id NULLS FIRST) <= part AS BIGINT) AS copies FROM o
"""


ORACLES = {"op6_mixing": _mixing(), "op7_near_dedup": NEAR_DEDUP, "op9_exact_dedup": EXACT_DEDUP}
