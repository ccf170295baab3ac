"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS top FROM q)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM r
"""


def op6() -> str:
    """Every unit against every template that shares a bigram."""
    from .licenses import TEMPLATES, THRESHOLD

    q = lambda x: "'" + x.replace("'", "''") + "'"
    templates = ", ".join(f"({i}, {q(name)}, {q(text)})" for i, (name, text) in enumerate(TEMPLATES))
    words = lambda x: f"string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (SELECT template, license, {grams} AS g FROM (SELECT v.template, v.license, {words('v.body')} AS w FROM (VALUES {templates}) v(template, license, body))),
tg AS (SELECT template, license, len(g) AS n, unnest(g) AS bigram FROM t),
l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(text, '') AS body FROM documents),
u AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS unit, unnest(lines) AS body FROM l UNION ALL SELECT doc_id, 0, body FROM l WHERE len(lines) > 1),
ug AS (SELECT doc_id, unit, len(g) AS n, unnest(g) AS bigram FROM (SELECT doc_id, unit, {grams} AS g FROM (SELECT doc_id, unit, {words('body')} AS w FROM u))),
c AS (SELECT doc_id, unit, template, license, 2e0 * count(*) / (any_value(ug.n) + any_value(tg.n)) AS dice FROM ug JOIN tg USING (bigram) GROUP BY doc_id, unit, template, license),
h AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, template) AS k FROM c WHERE dice >= {THRESHOLD!r}::DOUBLE),
p AS (SELECT doc_id, count(DISTINCT unit) AS n_units, max(license) FILTER (k = 1) AS license, max(dice) AS dice, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM h GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, license, dice, licenses FROM documents d LEFT JOIN p USING (doc_id)
"""


def op10() -> str:
    """Gaps and matches of each rule; the lengths before a match give its place."""
    from .secrets import BASE, RULES

    parts = []
    for k, r in enumerate(RULES):
        # these two count whole runs, so the length may as well stand in the pattern
        pattern = {"hex": "[0-9a-f]{16,}", "access": "AKIA[A-Z0-9]{14,}"}.get(r.kind, r.pattern).replace("'", "''")
        parts.append(f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, i, gaps, found, counted FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps,
  regexp_extract_all(t, '{pattern}', 0) AS found, regexp_extract_all(t, '{pattern}', {r.group}) AS counted FROM d WHERE regexp_matches(t, '{pattern}')), unnest(range(1, len(found) + 1)) x(i)""")
    shown = "kind || ':' || a || ':' || z"
    counts = ", ".join(f"count(*) FILTER (k = {k}) AS n_{r.kind}" for k, r in enumerate(RULES) if r.kind in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({' UNION ALL '.join(parts)}),
n AS (SELECT *, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0) AS begun FROM m WHERE length(counted[i]) >= least),
s AS (SELECT doc_id, k, kind, CAST(begun AS BIGINT) AS a, CAST(begun + length(found[i]) AS BIGINT) AS z FROM n)
SELECT d.doc_id, {counts}, sha256(coalesce(string_agg({shown}, ',' ORDER BY a, k) FILTER (k < {len(BASE)}), '')) AS base_sha256, coalesce(string_agg({shown}, ',' ORDER BY a, k), '') AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op3_warc": OP3, "op6_licenses": op6(), "op10_secrets": op10()}
