"""DuckDB SQL oracle for the registered queries.

A deliberately different formulation from the Spark plans: every touched
(order, run) is joined to *all* rows of that order up to that run (brute
force), and the "latest" rows are picked with window maxima / ``arg_max`` per
(order, run).  The tables ``orders``, ``customer`` and ``lineitem`` are the
views the checker registers.
"""

from __future__ import annotations

# Feed replay, bronze, expectations and ingest.
_BASE = r"""
hsrc AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderdate AS d, c_name
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderkey % 11 <> 0),
hf AS (
  SELECT 'O' || k AS hid, d AS hdate, 'C' || ck AS hcust, c_name AS hcustname,
         d + to_days(CAST(k % 13 AS INTEGER)) AS received FROM hsrc
  UNION ALL
  SELECT 'O' || k, d + to_days(400), CASE WHEN k % 30 = 0 THEN '' ELSE 'C' || ck END,
         c_name || '*', d + to_days(CAST(400 + k % 13 AS INTEGER)) FROM hsrc WHERE k % 3 = 0
  UNION ALL
  SELECT 'O' || k, d, 'C' || ck, c_name || '#', d + to_days(CAST(1 + k % 13 AS INTEGER))
  FROM hsrc WHERE k % 7 = 0
  UNION ALL
  SELECT 'O' || k, d, NULL, c_name, d + to_days(CAST(k % 13 AS INTEGER)) FROM hsrc WHERE k % 83 = 0
  UNION ALL
  SELECT 'O' || k, NULL, 'C' || ck, c_name, d + to_days(CAST(k % 13 AS INTEGER)) FROM hsrc WHERE k % 89 = 0
  UNION ALL
  SELECT NULL, d, 'C' || ck, c_name, d + to_days(CAST(k % 13 AS INTEGER)) FROM hsrc WHERE k % 97 = 0),
lf0 AS (
  SELECT l_orderkey AS k, l_linenumber AS n, 'O' || l_orderkey AS hid, 'L' || l_linenumber AS lid,
         CASE WHEN l_orderkey % 101 = 0 AND l_linenumber = 2 THEN NULL ELSE l_shipdate END AS ldate,
         'P' || l_partkey AS prod,
         CAST(CASE WHEN l_returnflag = 'R' AND l_quantity <= 10 THEN 0.0
                   WHEN l_orderkey % 103 = 0 AND l_linenumber = 1 THEN 0.5
                   WHEN l_orderkey % 107 = 0 THEN l_quantity + 0.75 ELSE l_quantity END AS DOUBLE) AS amt,
         l_shipdate + to_days(CAST(l_suppkey % 97 AS INTEGER)) AS received
  FROM lineitem),
lf AS (
  SELECT hid, lid, ldate, prod, amt, received FROM lf0
  UNION ALL SELECT hid, NULL, ldate, prod, amt, received FROM lf0 WHERE k % 97 = 0 AND n = 1
  UNION ALL SELECT NULL, lid, ldate, prod, amt, received FROM lf0 WHERE k % 89 = 0 AND n = 1),
rh_all AS (
  SELECT CAST(year(received) - 1994 AS BIGINT) AS run_id,
         coalesce(TRY_CAST(regexp_replace(hid, '[^0-9]', '', 'g') AS BIGINT), 0) // 1000 AS key_bucket,
         hid, hdate, hcust, hcustname,
         'replay/SOH_' || CAST(year(received) - 1994 AS VARCHAR) || '.json' AS source_file,
         coalesce(hdate, received) AS occurred, received
  FROM hf),
rl_all AS (
  SELECT CAST(year(received) - 1994 AS BIGINT) AS run_id,
         coalesce(TRY_CAST(regexp_replace(hid, '[^0-9]', '', 'g') AS BIGINT), 0) // 1000 AS key_bucket,
         hid, lid, ldate, prod, amt,
         'replay/SOL_' || CAST(year(received) - 1994 AS VARCHAR) || '.json' AS source_file,
         coalesce(ldate, received) AS occurred, received
  FROM lf),
rh AS (SELECT * FROM rh_all WHERE hid IS NOT NULL AND hdate IS NOT NULL AND hcust IS NOT NULL),
rl AS (SELECT * FROM rl_all WHERE hid IS NOT NULL AND lid IS NOT NULL),
H AS (
  SELECT run_id, key_bucket, 'SalesOrderHeader_' || hid AS order_id,
         CASE WHEN hcust = '' THEN true ELSE false END AS is_order_deleted,
         occurred, received, hcust AS cust_id, hcustname AS cust_name
  FROM rh),
L AS (
  SELECT run_id, key_bucket, 'SalesOrderHeader_' || hid AS order_id, 'SalesOrderLine_' || lid AS line_id,
         CASE WHEN TRY_CAST(trunc(amt) AS BIGINT) = 0 THEN true ELSE false END AS is_line_deleted,
         occurred, received, prod, TRY_CAST(trunc(amt) AS BIGINT) AS amt
  FROM rl),
T AS (
  SELECT DISTINCT run_id, key_bucket, order_id FROM (
    SELECT run_id, key_bucket, order_id FROM H UNION ALL SELECT run_id, key_bucket, order_id FROM L))"""

# Header state per touched (order, run): all header rows up to the run, rows
# at the newest event time collapsed.
_HEADER = r"""
HX AS (
  SELECT t.run_id AS r, t.key_bucket, t.order_id, h.run_id AS h_run, h.is_order_deleted,
         h.occurred, h.received, h.cust_id, h.cust_name,
         max(h.occurred) OVER (PARTITION BY t.run_id, t.key_bucket, t.order_id) AS mo
  FROM T t JOIN H h ON h.key_bucket = t.key_bucket AND h.order_id = t.order_id AND h.run_id <= t.run_id),
HS AS (
  SELECT r AS run_id, key_bucket, order_id, bool_or(is_order_deleted) AS is_order_deleted,
         max(occurred) AS occurred, max(received) AS received,
         arg_max(cust_id, (received, h_run, cust_id, cust_name)) AS cust_id,
         arg_max(cust_name, (received, h_run, cust_id, cust_name)) AS cust_name
  FROM HX WHERE occurred = mo GROUP BY r, key_bucket, order_id)"""

# All line rows of each touched order up to the run.
_LX = r"""
LX AS (
  SELECT t.run_id AS r, t.key_bucket, t.order_id, l.line_id, l.is_line_deleted, l.occurred,
         l.received, l.run_id AS line_run_id, l.prod, l.amt
  FROM T t JOIN L l ON l.key_bucket = t.key_bucket AND l.order_id = t.order_id AND l.run_id <= t.run_id)"""

_LINE_ARGMAX = r"""
LA0 AS (
  SELECT r, key_bucket, order_id, line_id,
         arg_max({'d': is_line_deleted, 'o': occurred, 'rc': received, 'u': line_run_id, 'p': prod, 'a': amt},
                 (occurred, received, line_run_id, prod, amt, is_line_deleted)) AS s
  FROM LX GROUP BY r, key_bucket, order_id, line_id),
LL AS (
  SELECT r AS run_id, key_bucket, order_id, line_id, s.d AS is_line_deleted, s.o AS occurred,
         s.rc AS received, s.u AS line_run_id, s.p AS prod, s.a AS amt FROM LA0)"""

_LINE_STRICT = r"""
LS0 AS (
  SELECT *, max(occurred) OVER w AS mo, max(received) OVER w AS mr, max(line_run_id) OVER w AS mu
  FROM LX WINDOW w AS (PARTITION BY r, key_bucket, order_id, line_id)),
LL AS (
  SELECT r AS run_id, key_bucket, order_id, line_id, is_line_deleted, occurred, received,
         line_run_id, prod, amt
  FROM LS0 WHERE occurred = mo AND received = mr AND line_run_id = mu)"""

_ORDER_LINES = r"""
OL AS (
  SELECT run_id, key_bucket, order_id, max(occurred) AS occurred, max(received) AS received,
         max(line_run_id) AS line_run_id,
         count(DISTINCT line_id) FILTER (WHERE NOT is_line_deleted) AS line_cnt,
         coalesce(string_agg(DISTINCT CASE WHEN NOT is_line_deleted THEN
                     line_id || ':' || coalesce(prod, '') || ':' || coalesce(CAST(amt AS VARCHAR), '') END,
                  ',' ORDER BY CASE WHEN NOT is_line_deleted THEN
                     line_id || ':' || coalesce(prod, '') || ':' || coalesce(CAST(amt AS VARCHAR), '') END), '') AS lines_text
  FROM LL GROUP BY run_id, key_bucket, order_id)"""

_VERSIONS = r"""
V0 AS (
  SELECT t.run_id, t.key_bucket, t.order_id,
         coalesce(h.occurred, o.occurred) AS occurred, coalesce(h.received, o.received) AS received,
         h.is_order_deleted, h.cust_id, h.cust_name,
         CAST(coalesce(o.line_cnt, 0) AS BIGINT) AS line_cnt, o.lines_text,
         coalesce(epoch_us(greatest(h.occurred, o.occurred)), 0) AS occurred_us,
         coalesce(epoch_us(greatest(h.received, o.received)), 0) AS received_us,
         coalesce(o.line_run_id, 0) AS line_run_id_s, t.run_id AS run_id_s
  FROM T t LEFT JOIN HS h USING (run_id, key_bucket, order_id)
           LEFT JOIN OL o USING (run_id, key_bucket, order_id)),
V AS (
  SELECT run_id, key_bucket, order_id, occurred, received, is_order_deleted, cust_id, cust_name,
         line_cnt, lines_text, occurred_us, received_us, line_run_id_s, run_id_s,
         CAST(100000000000000000 + occurred_us AS VARCHAR) || CAST(100000000000000000 + received_us AS VARCHAR)
         || CAST(100000000000000000 + line_run_id_s AS VARCHAR) || CAST(100000000000000000 + run_id_s AS VARCHAR)
         AS seq_string
  FROM V0),
FOLD AS (
  SELECT * FROM V
  QUALIFY row_number() OVER (PARTITION BY key_bucket, order_id
                             ORDER BY occurred_us DESC, received_us DESC, line_run_id_s DESC, run_id_s DESC) = 1)"""

_VCOLS = ("run_id, key_bucket, order_id, occurred, received, is_order_deleted, cust_id, "
          "cust_name, line_cnt, lines_text, seq_string")


# Columns that the header feed gains in the course of the replay.
_NEW = r"""
NEW AS (
  SELECT *, CASE WHEN run_id IN (3, 4) THEN n END AS whole, CASE WHEN run_id >= 5 THEN n + 0.5 END AS part,
         CASE WHEN run_id = 4 THEN n END AS number, CASE WHEN run_id > 4 THEN 'ch' || n END AS word,
         CASE WHEN run_id = 4 THEN 'note ' || hid END AS note
  FROM (SELECT *, length(hid) * 3 + length(hcustname) AS n FROM rh_all))"""


def _with(*parts: str) -> str:
    return "WITH" + ",".join(parts)


def _lines(mode: str) -> str:
    return _LINE_ARGMAX if mode == "argmax" else _LINE_STRICT


def _full(mode: str = "argmax") -> str:
    return _with(_BASE, _HEADER, _LX, _lines(mode), _ORDER_LINES, _VERSIONS)


def oracle_sql() -> dict[str, str]:
    base = _with(_BASE)
    full = _full()
    return {
        "replay_headers": base + "\nSELECT * FROM rh_all",
        "replay_lines": base + "\nSELECT * FROM rl_all",
        "key_bucket": base + """
SELECT key_bucket, count(*) AS n_lines, count(DISTINCT hid) AS n_orders,
       min(hid) AS min_hid, max(hid) AS max_hid FROM rl GROUP BY key_bucket""",
        "expect_headers": base + "\nSELECT * FROM rh",
        "expect_lines": base + "\nSELECT * FROM rl",
        "expectation_counts": base + """
SELECT 'raw_headers' AS dataset, 'valid_header_received' AS expectation, count(*) AS input_records,
       count(*) FILTER (WHERE hid IS NOT NULL AND hdate IS NOT NULL AND hcust IS NOT NULL) AS passed_records,
       count(*) FILTER (WHERE NOT (hid IS NOT NULL AND hdate IS NOT NULL AND hcust IS NOT NULL)) AS failed_records
FROM rh_all
UNION ALL
SELECT 'raw_lines', 'valid_line_received', count(*),
       count(*) FILTER (WHERE hid IS NOT NULL AND lid IS NOT NULL),
       count(*) FILTER (WHERE NOT (hid IS NOT NULL AND lid IS NOT NULL))
FROM rl_all""",
        "quarantine": base + """
SELECT run_id, 'line' AS feed, hid, lid, 'valid_line_received' AS failed FROM rl_all
WHERE NOT coalesce(hid IS NOT NULL AND lid IS NOT NULL, false)
UNION ALL
SELECT run_id, 'header', hid, NULL, 'valid_header_received' FROM rh_all
WHERE NOT coalesce(hid IS NOT NULL AND hdate IS NOT NULL AND hcust IS NOT NULL, false)""",
        "ingest_headers": base + "\nSELECT * FROM H",
        "ingest_lines": base + "\nSELECT * FROM L",
        "touched_keys": base + "\nSELECT * FROM T",
        "header_latest_ts": _with(_BASE, _HEADER) + "\nSELECT run_id, key_bucket, order_id, occurred FROM HS",
        "header_latest": _with(_BASE, _HEADER) + "\nSELECT * FROM HS",
        "header_latest_live": _with(_BASE, _HEADER) + """
SELECT r AS run_id, key_bucket, order_id, false AS is_order_deleted, max(occurred) AS occurred,
       max(received) AS received,
       arg_max(cust_id, (received, h_run, cust_id, cust_name)) AS cust_id,
       arg_max(cust_name, (received, h_run, cust_id, cust_name)) AS cust_name
FROM HX WHERE occurred = mo AND NOT is_order_deleted GROUP BY r, key_bucket, order_id""",
        "line_latest_ts": _with(_BASE, _LX) + """
SELECT r AS run_id, key_bucket, order_id, line_id, max(occurred) AS occurred,
       max(received) AS received, max(line_run_id) AS line_run_id
FROM LX GROUP BY r, key_bucket, order_id, line_id""",
        "line_latest": _with(_BASE, _LX, _LINE_ARGMAX) + "\nSELECT * FROM LL",
        "line_latest_strict": _with(_BASE, _LX, _LINE_STRICT) + "\nSELECT * FROM LL",
        "order_lines": _with(_BASE, _LX, _LINE_ARGMAX, _ORDER_LINES) + """
SELECT run_id, key_bucket, order_id, occurred, received, line_run_id,
       CAST(line_cnt AS INTEGER) AS line_cnt, lines_text FROM OL""",
        "order_versions": full + f"\nSELECT {_VCOLS} FROM V",
        "order_versions_strict": _full("strict") + f"\nSELECT {_VCOLS} FROM V",
        "seq_string": full + """
SELECT run_id, key_bucket, order_id, occurred_us, received_us, line_run_id_s AS line_run_id,
       run_id_s AS seq_run_id, seq_string FROM V""",
        "orders_latest": full + f"\nSELECT {_VCOLS} FROM FOLD WHERE NOT coalesce(is_order_deleted, false)",
        "orders_latest_strict": _full("strict")
        + f"\nSELECT {_VCOLS} FROM FOLD WHERE NOT coalesce(is_order_deleted, false)",
        "orders_latest_window": full + """
SELECT key_bucket, order_id, occurred, received, is_order_deleted, cust_id, cust_name,
       line_cnt, lines_text, seq_string FROM V
QUALIFY row_number() OVER (PARTITION BY key_bucket, order_id
                           ORDER BY occurred DESC, received DESC, run_id DESC) = 1""",
        "orders_as_of": full + f"""
SELECT {_VCOLS} FROM V WHERE run_id <= 4
QUALIFY row_number() OVER (PARTITION BY key_bucket, order_id
                           ORDER BY occurred_us DESC, received_us DESC, line_run_id_s DESC, run_id_s DESC) = 1
  AND NOT coalesce(is_order_deleted, false)""",
        "order_previous_version": full + f"""
SELECT {_VCOLS}, CAST(2 AS INTEGER) AS version_rank FROM V
QUALIFY row_number() OVER (PARTITION BY key_bucket, order_id
                           ORDER BY occurred_us DESC, received_us DESC, line_run_id_s DESC, run_id_s DESC) = 2""",
        "order_history_sorted": full + f"""
SELECT {_VCOLS}, row_number() OVER (PARTITION BY key_bucket, order_id
                                    ORDER BY occurred DESC, received DESC, run_id DESC) AS place FROM V""",
        "records_as_json": base + """
SELECT run_id, 'SOH' AS feed, hid, CAST(NULL AS VARCHAR) AS lid, hdate AS event_time, hcust, hcustname,
       CAST(NULL AS VARCHAR) AS prod, CAST(NULL AS DOUBLE) AS amt, received FROM rh_all
UNION ALL
SELECT run_id, 'SOL', hid, lid, ldate, NULL, NULL, prod, amt, received FROM rl_all""",
        "touched_per_run": base + """
SELECT run_id, count(*) AS touched_orders, count(DISTINCT key_bucket) AS touched_buckets
FROM T GROUP BY run_id""",
        "deleted_orders": full + f"\nSELECT {_VCOLS} FROM FOLD WHERE coalesce(is_order_deleted, false)",
        "headerless_orders": full + f"""
SELECT {_VCOLS} FROM FOLD WHERE NOT coalesce(is_order_deleted, false) AND is_order_deleted IS NULL""",
        "incremental_versions": full + f"\nSELECT {_VCOLS} FROM V",
        "purged_deletes": full + """
SELECT key_bucket, order_id, seq_string FROM FOLD WHERE coalesce(is_order_deleted, false)""",
        "incremental_versions_strict": _full("strict") + f"\nSELECT {_VCOLS} FROM V",
        "evolved_headers": _with(_BASE, _NEW) + """
SELECT run_id, key_bucket, hid, hdate, hcust, hcustname, received,
       CAST(coalesce(whole, part) AS DOUBLE) AS priority, coalesce(CAST(number AS VARCHAR), word) AS channel
FROM NEW""",
        "schema_versions": _with(_BASE, _NEW) + """,
SEEN AS (
  SELECT run_id, 'priority' AS name, max(CASE WHEN part IS NOT NULL THEN 2 ELSE 1 END) AS wide
  FROM NEW WHERE coalesce(whole, part) IS NOT NULL GROUP BY run_id
  UNION ALL
  SELECT run_id, 'channel', max(CASE WHEN word IS NOT NULL THEN 3 ELSE 1 END)
  FROM NEW WHERE number IS NOT NULL OR word IS NOT NULL GROUP BY run_id
  UNION ALL
  SELECT run_id, 'note', 3 FROM NEW WHERE note IS NOT NULL GROUP BY run_id),
KIND AS (
  SELECT a.run_id, a.name, count(*) AS seen, max(b.wide) AS wide
  FROM SEEN a JOIN SEEN b ON a.name = b.name AND b.run_id <= a.run_id GROUP BY a.run_id, a.name)
SELECT 'header' AS feed, run_id, name,
       CASE wide WHEN 1 THEN 'bigint' WHEN 2 THEN 'double' ELSE 'string' END AS kind,
       CASE WHEN seen = 2 THEN 'added' ELSE 'widened' END AS change
FROM KIND k
WHERE seen = 2 OR (seen > 2 AND wide > (SELECT max(wide) FROM KIND e WHERE e.name = k.name AND e.seen = k.seen - 1))""",
        "incremental_latest": full + f"\nSELECT {_VCOLS} FROM FOLD WHERE NOT coalesce(is_order_deleted, false)",
        "stream_latest": full + f"\nSELECT {_VCOLS} FROM FOLD WHERE NOT coalesce(is_order_deleted, false)",
        "line_counts_by_state": full + """
SELECT CASE WHEN lines_text IS NULL THEN 'no_lines' WHEN lines_text = '' THEN 'all_deleted'
            ELSE 'live' END AS line_state,
       count(*) AS orders, CAST(sum(line_cnt) AS BIGINT) AS live_lines
FROM FOLD WHERE NOT coalesce(is_order_deleted, false) GROUP BY 1""",
    }
