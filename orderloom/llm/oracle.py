"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from orderloom.llm.license_scan import TEMPLATES, THRESHOLD, anchors, template_rows, window_templates
from orderloom.llm.url_reputation import SUFFIXES

OP8 = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
o AS (SELECT doc_id AS page_id, CASE WHEN quality = 1 AND toxic = 0 THEN 1
             WHEN quality <> 1 OR toxic <> 0 THEN 0 END AS good FROM labels),
a AS (SELECT (coalesce(sum(good), 0) + 1) / (count(good) + 2)::DOUBLE AS m FROM o),
h0 AS (SELECT host, regexp_replace(host, ':[0-9]*$', '') AS name,
              coalesce(sum(good), 0)::DOUBLE AS g, count(good)::DOUBLE AS n
       FROM p LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (SELECT *, string_split(name, '.') AS parts, regexp_full_match(name, '[0-9.]+') OR starts_with(name, '[') AS ip,
              array_to_string(string_split(name, '.')[-2:], '.') IN (SUFFIX_LIST) AS two FROM h0),
h AS (SELECT host, g, n, CASE WHEN ip THEN name WHEN two THEN array_to_string(parts[-3:], '.')
                              ELSE array_to_string(parts[-2:], '.') END AS domain,
             CASE WHEN ip THEN name WHEN two THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix
      FROM h1),
d0 AS (SELECT domain, suffix, sum(g) AS g, sum(n) AS n, sum(CASE WHEN n > 0 THEN g * g / n ELSE 0 END) AS q,
              sum(n * n) AS n2, count(*) FILTER (n > 0) AS k FROM h GROUP BY domain, suffix),
s0 AS (SELECT suffix, sum(g) AS g, sum(n) AS n, sum(CASE WHEN n > 0 THEN g * g / n ELSE 0 END) AS q,
              sum(n * n) AS n2, count(*) FILTER (n > 0) AS k FROM d0 GROUP BY suffix),
t0 AS (SELECT sum(g) AS g, sum(n) AS n, sum(CASE WHEN n > 0 THEN g * g / n ELSE 0 END) AS q,
              sum(n * n) AS n2, count(*) FILTER (n > 0) AS k FROM s0),
lv AS (SELECT 'd' AS lev, * FROM d0 UNION ALL SELECT 's', NULL, * FROM s0 UNION ALL SELECT 't', NULL, NULL, * FROM t0),
sq AS (SELECT *, CASE WHEN n > 0 THEN q - g * g / n ELSE 0 END AS s,
              CASE WHEN n > 0 THEN g * (n - g) / (n * n) * (k - 1) ELSE 0 END AS w,
              CASE WHEN n > 0 THEN g * (n - g) / (n * n) * (n - n2 / n) ELSE 0 END AS v FROM lv),
pool AS (SELECT lev, CASE WHEN sum(v) - sum(w) > 1e-9 THEN
                1 / least(greatest((sum(s) - sum(w)) / (sum(v) - sum(w)), 1e-4), 0.5) - 1 ELSE 20 END AS st
         FROM sq GROUP BY lev),
fit AS (SELECT sq.*, CASE WHEN k >= 10 AND v - w > 1e-9 THEN
               1 / least(greatest((s - w) / (v - w), 1e-4), 0.5) - 1 ELSE st END AS st FROM sq JOIN pool USING (lev)),
sfx AS (SELECT suffix, st, ((SELECT m FROM a) * (SELECT st FROM fit WHERE lev = 't') + g)
                           / (n + (SELECT st FROM fit WHERE lev = 't')) AS sm FROM fit WHERE lev = 's'),
d AS (SELECT domain, suffix, f.st AS ds, (sm * sfx.st + g) / (n + sfx.st) AS dm
      FROM fit f JOIN sfx USING (suffix) WHERE lev = 'd'),
b AS (SELECT host, dm * ds + g AS a, (1 - dm) * ds + n - g AS b FROM h JOIN d USING (domain, suffix)),
v AS (SELECT host, CASE WHEN a / (a + b) - 2 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) < 0.5
                        THEN 'block' ELSE 'allow' END AS verdict FROM b),
r(rule, rhost, rpath, rverdict) AS (VALUES ('net/', 'net', '/', 'block'),
  ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'),
  ('org/fr/', 'org', '/fr/', 'allow')),
f AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rv
      FROM (SELECT DISTINCT host, path FROM p)
      JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(rv, verdict) AS verdict
FROM p LEFT JOIN f USING (host, path) JOIN v USING (host)
""".replace("SUFFIX_LIST", ", ".join(f"'{x}'" for x in SUFFIXES))


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


TEMPLATE_VALUES = ", ".join(f"({i}, '{name}', {_list(grams)})" for i, (name, grams)
                            in enumerate(template_rows(TEMPLATES)))

WINDOW_ROWS = window_templates(TEMPLATES)
WINDOW_VALUES = ", ".join(f"({i}, '{name}', {_list(grams)})" for i, (name, grams) in enumerate(WINDOW_ROWS))

OP7 = rf"""
WITH t(ord, license, tb) AS (VALUES {TEMPLATE_VALUES}),
d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS txt,
             string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT r, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS unit FROM d
      UNION ALL SELECT r, -1, txt FROM d WHERE len(ls) > 1),
w AS (SELECT r, line_no, string_split(trim(regexp_replace(
        lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS ws FROM u),
b AS (SELECT r, line_no, list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) AS bs
      FROM w WHERE len(ws) > 1),
m AS (SELECT r, line_no, license, ord, 2.0 * len(list_intersect(bs, tb)) / (len(bs) + len(tb)) AS dice
      FROM b JOIN t ON 3 * len(bs) >= 2 * len(tb) AND 2 * len(bs) <= 3 * len(tb)),
best AS (SELECT r, line_no, license FROM m WHERE dice >= 0.8
         QUALIFY row_number() OVER (PARTITION BY r, line_no ORDER BY dice DESC, ord) = 1),
g AS (SELECT r, count(*) AS n,
             array_to_string(list_sort(list_distinct(list(license))), ',') AS licenses,
             string_agg(license || ':' || line_no, ',' ORDER BY CASE line_no WHEN -1 THEN 1e18 ELSE line_no END)
             AS matches FROM best GROUP BY r),
x AS (SELECT r, string_split(trim(regexp_replace(lower(txt), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS ws FROM d),
y AS (SELECT r, [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] AS gs FROM x WHERE len(ws) > 1),
z AS (SELECT r, generate_subscripts(gs, 1) AS i, unnest(gs) AS bg FROM y),
k AS (SELECT unnest({_list(anchors(WINDOW_ROWS, THRESHOLD))}) AS bg),
v(ord, license, tg) AS (VALUES {WINDOW_VALUES}),
c AS (SELECT z.r, z.i, v.ord, v.license, list_distinct(v.tg) AS tb, len(v.tg) AS m,
             greatest(1, z.i - list_position(v.tg, z.bg) + 1) AS s
      FROM z SEMI JOIN k USING (bg) JOIN v ON list_contains(v.tg, z.bg)),
e AS (SELECT r, i, ord, license, s, tb, list_distinct(gs[s:s + m - 1]) AS wb FROM c JOIN y USING (r)),
f AS (SELECT DISTINCT r, s, license FROM (
        SELECT *, 2.0 * len(list_intersect(wb, tb)) / (len(wb) + len(tb)) AS dice FROM e
        QUALIFY row_number() OVER (PARTITION BY r, i ORDER BY dice DESC, ord) = 1) WHERE dice >= 0.8),
h AS (SELECT r, count(*) AS n_windows, string_agg(license || ':' || s, ',' ORDER BY s, license) AS windows
      FROM f GROUP BY r)
SELECT doc_id, len(ls) AS n_lines, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses,
       coalesce(matches, '') AS matches, coalesce(n_windows, 0) AS n_windows, coalesce(windows, '') AS windows
FROM d LEFT JOIN g USING (r) LEFT JOIN h USING (r)
"""

OP11 = """
WITH o AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, l, xor(4294967295, list_reduce(
        list_prepend(4294967295, [ascii(b)::BIGINT FOR b IN string_split(c::VARCHAR, '')]),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                   lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 9 AS h FROM o),
b AS (SELECT h.c, coalesce(p.l, [])[1:h.h] || h.l[h.h + 1:] AS l
      FROM h LEFT JOIN o p ON p.c = h.c - h.c % 5),
m AS (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM b),
n AS (SELECT l[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
             coalesce(sha256(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(l) = d)),
                      sha256('')) AS ends_sha256
      FROM m GROUP BY 1, 2),
p AS (SELECT n.*, u.conv_id AS parent_conv_id FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.k = n.k[1:n.d - 1]),
w AS (SELECT p.*, coalesce(q.kids, 0) AS n_children,
             (p.n_convs - 1) * coalesce(strlen(p.k[p.d].x), 0) AS saved
      FROM p LEFT JOIN (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1, 2) q
      ON q.d = p.d AND q.k = p.k),
s AS (SELECT k[1:a] AS k, a AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
             sum(saved) AS saved_tokens
      FROM (SELECT *, unnest(range(d + 1)) AS a FROM w) GROUP BY 1, 2)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM w JOIN s USING (k, d)
"""

ORACLE: dict[str, str] = {
    "op11_prefix_trie": OP11,
    "op7_license_scan": OP7,
    "op8_url_reputation": OP8,
}
