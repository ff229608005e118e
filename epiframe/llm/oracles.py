"""DuckDB SQL for the queries that SQL can express."""

OP5 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
sh AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT r, i, sh.n, item_id FROM sh JOIN win ON sh.s = win.s AND sh.n = win.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


def _runs(kind: str, no: int, pattern: str, good: str) -> str:
    return f"""
{kind}_m AS (SELECT r, regexp_extract_all(t, {pattern}) AS m, regexp_split_to_array(t, {pattern}) AS g FROM d),
{kind} AS (SELECT r, '{kind}' AS kind, {no} AS no, s, s + len(x) AS e FROM (
    SELECT r, m[i] AS x, list_sum(list_transform(g[1:i], lambda y: len(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: len(y))), 0) AS s
    FROM (SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM {kind}_m WHERE len(m) > 0)) WHERE {good})"""


_HEAD = r"""'(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{_runs("assign", 0, _HEAD + "[A-Za-z0-9+/_.=-]+'", f"len(regexp_replace(x, {_HEAD.replace("'(?i", "'^(?i", 1)}', '')) >= 12")},
{_runs("access", 1, "'AKIA[A-Z0-9]+'", "len(x) >= 18")},
{_runs("hex", 2, "'[0-9a-f]+'", "len(x) >= 16")},
f AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS na, count(*) FILTER (kind = 'access') AS nk, count(*) FILTER (kind = 'hex') AS nh,
      string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, no) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(na, 0)::BIGINT AS n_assign, coalesce(nk, 0)::BIGINT AS n_access, coalesce(nh, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)
"""

OP10 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, i, l[i] AS line,
        translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT r, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
c AS (SELECT k, min(doc_id) AS first FROM x WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
y AS (SELECT x.*, c.first IS NOT NULL AND x.doc_id <> c.first AS gone FROM x LEFT JOIN c USING (k))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM y GROUP BY r
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": OP5, "op8_secret_scan": OP8, "op10_line_dedup": OP10}
