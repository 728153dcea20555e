"""DuckDB twins of the registered queries (independent SQL formulations).

Tables are the pre-registered views ``region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations``.
Column names and types are kept equal to the Spark side: counts are BIGINT,
money is DECIMAL(18,2), days are DATE, and no processing timestamp is returned.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared CTE text

# Orders as a log; the last order of a (customer, day) wins.
_STATE = """
st AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, o_orderkey,
         o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                             ORDER BY o_orderkey DESC) = 1)"""

# FURNITURE customers exit 30 days after their last order.
_EXITS = """
ex AS (
  SELECT o.o_custkey AS xk,
         CAST(max(CAST(o.o_orderdate AS DATE)) + INTERVAL 30 DAY AS DATE) AS exit_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment = 'FURNITURE'
  GROUP BY o.o_custkey)"""

_HIST = f"""
WITH {_STATE},
{_EXITS},
lv AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS nx FROM st),
hist AS (
  SELECT o_custkey, valid_from,
         CASE WHEN nx IS NOT NULL THEN CAST(nx - INTERVAL 1 DAY AS DATE)
              ELSE coalesce(exit_date, DATE '9999-12-31') END AS valid_to,
         o_orderkey, o_orderstatus, o_orderpriority, price
  FROM lv LEFT JOIN ex ON o_custkey = xk),
h AS (SELECT o_custkey, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current,
             o_orderkey, o_orderstatus, o_orderpriority, price FROM hist)"""

_ROWHASH = ("md5(concat_ws('||', coalesce(CAST(o_orderstatus AS VARCHAR), 'NULL'), "
            "coalesce(CAST(o_orderpriority AS VARCHAR), 'NULL'), "
            "coalesce(CAST(price AS VARCHAR), 'NULL')))")

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- history

SQL["scd2_history"] = _HIST + "\nSELECT * FROM h"

SQL["next_event"] = f"""
WITH {_STATE}
SELECT o_custkey, valid_from, next_from, o_orderkey, o_orderstatus, o_orderpriority, price,
       coalesce(CAST(next_from - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS next_from
      FROM st) t"""

SQL["current_versions"] = _HIST + "\nSELECT * FROM h WHERE is_current"

SQL["versions_per_key"] = _HIST + """
SELECT o_custkey, count(*) AS n_versions, CAST(count_if(is_current) AS BIGINT) AS n_current
FROM h GROUP BY o_custkey"""

SQL["interval_violations"] = f"""
WITH {_EXITS},
ev AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
lv AS (SELECT *, lead(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS nx FROM ev),
v AS (SELECT o_custkey, o_orderkey, d AS valid_from,
             CASE WHEN nx IS NOT NULL THEN CAST(nx - INTERVAL 1 DAY AS DATE)
                  ELSE coalesce(exit_date, DATE '9999-12-31') END AS valid_to
      FROM lv LEFT JOIN ex ON o_custkey = xk)
SELECT * FROM v WHERE valid_from > valid_to"""

SQL["history_invariants"] = _HIST + """,
p AS (SELECT o_custkey, valid_from, valid_to, is_current FROM h
      UNION ALL SELECT o_custkey, valid_from, valid_from + 400, true FROM h WHERE o_custkey % 20 = 0
      UNION ALL SELECT o_custkey, valid_from, valid_from - 5, false FROM h WHERE o_custkey % 21 = 0
      UNION ALL SELECT o_custkey, valid_to + 100, valid_to + 200, false FROM h
                WHERE o_custkey % 22 = 0 AND valid_to < DATE '9999-12-31'),
lg AS (SELECT o_custkey, valid_from, max(valid_to) OVER (
                PARTITION BY o_custkey ORDER BY valid_from, valid_to
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe
       FROM p WHERE valid_from <= valid_to)
SELECT (SELECT count(*) FROM p WHERE valid_from > valid_to) AS inverted,
       (SELECT count(*) FROM lg WHERE valid_from <= pe) AS overlaps,
       (SELECT count(*) FROM lg WHERE valid_from > pe + 1) AS gaps,
       (SELECT count(*) FROM (SELECT o_custkey FROM p WHERE is_current
                              GROUP BY o_custkey HAVING count(*) > 1) t) AS multi_current"""

SQL["surrogate_key"] = _HIST + """
SELECT o_custkey, valid_from,
       md5(concat_ws('||', CAST(o_custkey AS VARCHAR), CAST(valid_from AS VARCHAR))) AS version_sk
FROM h"""

SQL["row_hash"] = _HIST + f"""
SELECT o_custkey, valid_from, o_orderstatus, o_orderpriority, price, {_ROWHASH} AS row_hash
FROM h"""

SQL["scd2_enriched"] = _HIST + """
SELECT h.o_custkey, valid_from, valid_to, is_current, o_orderstatus, o_orderpriority, price,
       c.c_name, c.c_mktsegment
FROM h LEFT JOIN customer c ON h.o_custkey = c.c_custkey"""

SQL["first_multi_version_key"] = _HIST + """
SELECT o_custkey, valid_from, valid_to, is_current, o_orderkey, o_orderstatus, o_orderpriority,
       price
FROM h
WHERE o_custkey = (SELECT min(o_custkey) FROM
                   (SELECT o_custkey FROM h GROUP BY o_custkey HAVING count(*) >= 3) t)"""

# ---------------------------------------------------------------- marts

_FACTS = """
f AS (SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS ship_date, o.o_custkey
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_CDIM = """
cd AS (SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name
       FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_DV = f""",
{_CDIM},
dv AS (SELECT md5(concat_ws('||', CAST(h.o_custkey AS VARCHAR), CAST(valid_from AS VARCHAR)))
              AS version_sk,
              h.o_custkey, valid_from, valid_to, is_current, o_orderstatus, o_orderpriority,
              price, {_ROWHASH} AS row_hash, cd.c_name, cd.c_mktsegment, cd.n_name, cd.r_name
       FROM h LEFT JOIN cd ON h.o_custkey = cd.c_custkey)"""

SQL["fact_events_asof"] = _HIST + f""",
{_FACTS}
SELECT f.l_orderkey, f.l_linenumber, f.o_custkey, f.ship_date, h.valid_from, h.valid_to,
       h.o_orderstatus, h.o_orderpriority
FROM f LEFT JOIN h ON f.o_custkey = h.o_custkey AND f.ship_date BETWEEN h.valid_from AND h.valid_to"""

SQL["headcount_snapshot"] = _HIST + """,
m AS (SELECT CAST(last_day(CAST(g AS DATE)) AS DATE) AS month_end
      FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH) t(g))
SELECT m.month_end, h.o_orderstatus, count(*) AS headcount
FROM m JOIN h ON h.valid_from <= m.month_end AND m.month_end <= h.valid_to
GROUP BY m.month_end, h.o_orderstatus"""

_LEVELS = {"o_orderstatus,c_mktsegment": ("st", "sg"), "o_orderstatus": ("st", "NULL"), "c_mktsegment": ("NULL", "sg"),
           "all": ("NULL", "NULL")}

SQL["headcount_movements"] = _HIST + """,
hv AS (SELECT h.o_custkey AS k, valid_from, valid_to, o_orderstatus AS st, c_mktsegment AS sg
       FROM h LEFT JOIN customer ON h.o_custkey = c_custkey),
m AS (SELECT CAST(last_day(CAST(g AS DATE)) AS DATE) AS month_end, CAST(g AS DATE) - 1 AS prev_end
      FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH) t(g)),
cur AS (SELECT month_end, k, st, sg FROM m JOIN hv ON month_end BETWEEN valid_from AND valid_to),
prv AS (SELECT month_end, k, st, sg FROM m JOIN hv ON prev_end BETWEEN valid_from AND valid_to),
mv AS (SELECT month_end, cur.k IS NOT NULL AS here, prv.k IS NOT NULL AS was, cur.st AS st, cur.sg AS sg,
              prv.st AS pst, prv.sg AS psg
       FROM cur FULL JOIN prv USING (month_end, k)),
levels AS (""" + " UNION ALL ".join(f"""
  SELECT '{level}' AS level, month_end, here, was, {a} AS a, {b} AS b, {a.replace("s", "ps", 1)} AS pa, {b.replace("s", "ps", 1)} AS pb
  FROM mv""" for level, (a, b) in _LEVELS.items()) + """),
sides AS (
  SELECT level, month_end, a, b, 0 AS opening, NOT was AS entry, was AND (a IS DISTINCT FROM pa OR b IS DISTINCT FROM pb) AS tin,
         false AS tout, false AS leave, 1 AS closing FROM levels WHERE here
  UNION ALL
  SELECT level, month_end, pa, pb, 1, false, false, here AND (a IS DISTINCT FROM pa OR b IS DISTINCT FROM pb), NOT here, 0
  FROM levels WHERE was)
SELECT level, month_end, a AS o_orderstatus, b AS c_mktsegment, CAST(sum(opening) AS BIGINT) AS opening,
       CAST(count_if(entry) AS BIGINT) AS entries, CAST(count_if(tin) AS BIGINT) AS transfers_in,
       CAST(count_if(tout) AS BIGINT) AS transfers_out, CAST(count_if(leave) AS BIGINT) AS exits,
       CAST(sum(closing) AS BIGINT) AS closing
FROM sides GROUP BY level, month_end, a, b"""

SQL["reporting_lines"] = _HIST.replace("WITH ", "WITH RECURSIVE ", 1) + """,
e AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 40 = 0 THEN o_custkey + 1 WHEN o_custkey % 40 = 1 THEN o_custkey - 1
                                  WHEN o_orderstatus = 'F' THEN o_custkey - 1
                                  WHEN o_orderstatus = 'O' THEN o_custkey // 2 ELSE o_custkey // 3 END AS boss
      FROM h WHERE DATE '2000-06-30' BETWEEN valid_from AND valid_to),
way AS (SELECT k, k AS top, [k] AS path FROM e
        UNION ALL
        SELECT way.k, up.k, list_append(path, up.k) FROM way JOIN e ON e.k = way.top JOIN e AS up ON up.k = e.boss
        WHERE NOT list_contains(path, up.k)),
whole AS (SELECT k, path, top FROM way QUALIFY row_number() OVER (PARTITION BY k ORDER BY len(path) DESC) = 1),
ended AS (SELECT whole.k, path, e.boss AS back, list_contains(path, e.boss) AS loops, whole.top
          FROM whole JOIN e ON e.k = whole.top)
SELECT ended.k AS o_custkey, CAST(e.boss AS BIGINT) AS manager,
       CASE WHEN loops THEN list_min(path[list_position(path, back):]) ELSE top END AS root,
       CASE WHEN NOT loops THEN len(path) - 1 END AS depth,
       CASE WHEN NOT loops THEN 'line' WHEN back = ended.k THEN 'loop' ELSE 'into_loop' END AS status
FROM ended JOIN e ON e.k = ended.k"""

SQL["namesake_customers"] = """
WITH c AS (SELECT c_custkey AS k, translate(md5(CAST(c_custkey AS VARCHAR)), '0123456789', 'ghijklmnop') AS h FROM customer),
people AS (
  SELECT k AS key, CASE WHEN k % 10 = 7 THEN 'nomen nescio' WHEN k % 50 = 8 THEN 'nomen nescoi'
                        ELSE h[1:6] || ' ' || h[7:14] END AS name FROM c
  UNION ALL
  SELECT k + 1000000000, CASE WHEN k % 3 = 0 THEN h[1:3] || h[5:6] || ' ' || h[7:14]
                              WHEN k % 3 = 1 THEN h[1:6] || ' z' || h[8:14]
                              ELSE h[2:2] || h[1:1] || h[3:6] || ' ' || h[7:14] END FROM c WHERE k % 10 = 3
  UNION ALL
  SELECT k + 2000000000, upper(h[1:6] || ' ' || h[7:14]) FROM c WHERE k % 10 = 4),
p AS (SELECT key, upper(name) AS name FROM people)
SELECT x.key, x.name, CAST(count_if(x.name = y.name) - 1 AS BIGINT) AS n_same,
       CAST(count_if(x.name <> y.name) AS BIGINT) AS n_near, min(y.key) AS first_key
FROM p x JOIN p y ON damerau_levenshtein(x.name, y.name) <= 1
GROUP BY x.key, x.name"""

SQL["dim_versioned"] = _HIST + _DV + "\nSELECT * FROM dv"

SQL["obt"] = _HIST + _DV + f""",
{_FACTS}
SELECT f.l_orderkey, f.l_linenumber, f.ship_date, f.o_custkey, dv.version_sk, dv.o_orderstatus,
       dv.price, dv.c_name, dv.c_mktsegment, dv.n_name, dv.r_name
FROM f LEFT JOIN dv ON f.o_custkey = dv.o_custkey AND f.ship_date BETWEEN dv.valid_from AND dv.valid_to"""

SQL["incremental_changes"] = _HIST + f""",
k AS (SELECT *, {_ROWHASH} AS row_hash FROM h),
cur AS (SELECT o_custkey, row_hash FROM k WHERE DATE '2000-12-31' BETWEEN valid_from AND valid_to),
inc AS (SELECT o_custkey, row_hash FROM k WHERE DATE '2001-06-30' BETWEEN valid_from AND valid_to)
SELECT coalesce(cur.o_custkey, inc.o_custkey) AS o_custkey,
       CASE WHEN cur.o_custkey IS NULL THEN 'new' WHEN inc.o_custkey IS NULL THEN 'gone'
            WHEN cur.row_hash = inc.row_hash THEN 'unchanged' ELSE 'changed' END AS change,
       cur.row_hash AS current_hash, inc.row_hash AS incoming_hash
FROM cur FULL OUTER JOIN inc ON cur.o_custkey = inc.o_custkey"""

_CAL = """
SELECT CAST(o_orderdate AS DATE) AS holiday_date,
       'order ' || CAST(o_orderkey AS VARCHAR) AS holiday_name,
       o_orderpriority AS local_name, o_orderstatus AS country_code,
       o_totalprice >= 100000 AS fixed, o_orderpriority IN ('1-URGENT', '2-HIGH') AS "global",
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE split_part(o_orderpriority, '-', 1) END
           AS holiday_type
FROM orders"""

SQL["shape_calendar"] = _CAL + """
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'"""

SQL["dim_date"] = f"""
WITH cal AS ({_CAL}
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'),
pd AS (SELECT holiday_date, min(holiday_name) AS holiday_name, count(*) AS n
       FROM cal WHERE country_code = 'O' GROUP BY holiday_date),
days AS (SELECT CAST(g AS DATE) AS date
         FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) t(g))
SELECT days.date, CAST(year(days.date) AS INTEGER) AS year,
       CAST(month(days.date) AS INTEGER) AS month, CAST(day(days.date) AS INTEGER) AS day,
       dayofweek(days.date) IN (0, 6) AS is_weekend, pd.n IS NOT NULL AS is_public_holiday,
       pd.holiday_name, coalesce(pd.n, 0) AS n_holidays
FROM days LEFT JOIN pd ON days.date = pd.holiday_date"""

SQL["date_window"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'"""

# ---------------------------------------------------------------- cleaning

def _parse(c: str) -> str:
    return (f"CAST(coalesce(try_strptime(trim({c}), '%Y-%m-%d'), "
            f"try_strptime(trim({c}), '%d-%m-%Y')) AS DATE)")


def _int(c: str) -> str:
    return f"TRY_CAST(TRY_CAST(trim({c}) AS DECIMAL(38,6)) AS INTEGER)"


_OT = """
ot AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
              CAST(o_totalprice AS DECIMAL(18,2)) AS price,
              CASE WHEN o_orderkey % 97 = 0 THEN '2026-13-01'
                   WHEN o_orderkey % 97 = 1 THEN strftime(o_orderdate, '%d-%m-%Y')
                   ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text
       FROM orders)"""

_CT = """
ct AS (SELECT c_custkey,
              CASE WHEN c_custkey % 4 = 0 THEN '  ' || c_name || ' '
                   WHEN c_custkey % 5 = 0 THEN chr(9) || c_name ELSE c_name END AS name_text,
              CASE WHEN c_custkey % 9 = 0 THEN '   ' WHEN c_custkey % 9 = 1 THEN ''
                   ELSE ' ' || c_mktsegment END AS segment_text,
              CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || '.0' AS balance_text,
              CASE WHEN c_acctbal > 0 THEN 'TRUE' ELSE 'false' END AS active_text
       FROM customer)"""

_ET = """
et AS (SELECT event_id, user_id,
              CASE WHEN event_id % 3 = 0 THEN upper(event_type)
                   WHEN event_id % 3 = 1 THEN ' ' || event_type || ' '
                   ELSE event_type END AS type_text,
              CASE WHEN event_id % 7 = 0 THEN strftime(ts, '%d-%m-%Y')
                   ELSE strftime(ts, '%Y-%m-%d') END AS date_text,
              CASE WHEN event_id % 4 = 0
                   THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.0'
                   ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS amount_text,
              CASE WHEN event_id % 5 = 0 THEN '  ' ELSE props END AS note_text
       FROM events)"""

SQL["parse_dates"] = f"""
WITH {_OT}
SELECT o_orderkey, date_text, {_parse('date_text')} AS order_date FROM ot"""

SQL["quarantine_split"] = f"""
WITH {_OT},
od AS (SELECT o_orderkey, CASE WHEN o_orderkey % 89 <> 2 THEN date_text END AS date_text,
              CASE WHEN o_orderkey % 83 = 5 THEN -price ELSE price END AS price FROM ot),
v AS (SELECT o_orderkey,
             NULLIF(concat_ws(',',
                CASE WHEN date_text IS NOT NULL AND {_parse('date_text')} IS NULL
                     THEN 'bad_date' END,
                CASE WHEN date_text IS NULL THEN 'null_date' END,
                CASE WHEN price <= 0 THEN 'nonpositive_price' END), '') AS violations
      FROM od)
SELECT o_orderkey, violations IS NOT NULL AS quarantined, violations FROM v"""

SQL["safe_int_cast"] = f"""
SELECT p_partkey, size_text, {_int('size_text')} AS size_int
FROM (SELECT p_partkey,
             CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) || '.0'
                  WHEN p_partkey % 11 = 0 THEN 'x' || CAST(p_size AS VARCHAR)
                  ELSE CAST(p_size AS VARCHAR) END AS size_text
      FROM part) t"""

SQL["text_to_bool"] = """
SELECT o_orderkey, flag_text, coalesce(upper(trim(flag_text)) = 'TRUE', false) AS flag
FROM (SELECT o_orderkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN 'TRUE'
                  WHEN o_orderstatus = 'O' THEN ' true ' ELSE 'no' END AS flag_text
      FROM orders) t"""

SQL["blank_to_null"] = f"""
WITH {_CT}
SELECT c_custkey, segment_text, NULLIF(trim(segment_text), '') AS c_mktsegment FROM ct"""

SQL["trim_strings"] = f"""
WITH {_CT}
SELECT c_custkey, trim(name_text) AS name_text, trim(segment_text) AS segment_text FROM ct"""

SQL["upper_normalise"] = f"""
WITH {_ET}
SELECT event_id, type_text, upper(trim(type_text)) AS event_type FROM et"""

SQL["untrimmed_profile"] = f"""
WITH {_CT}
SELECT CAST(count_if(name_text <> trim(name_text)) AS BIGINT) AS untrimmed_name_text,
       CAST(count_if(segment_text <> trim(segment_text)) AS BIGINT) AS untrimmed_segment_text
FROM ct"""

SQL["clean_events"] = f"""
WITH {_ET}
SELECT event_id, user_id, upper(trim(type_text)) AS event_type,
       {_parse('date_text')} AS event_date, {_int('amount_text')} AS amount,
       NULLIF(trim(note_text), '') AS note
FROM et"""

SQL["clean_roster"] = f"""
WITH {_CT}
SELECT c_custkey, trim(name_text) AS c_name, NULLIF(trim(segment_text), '') AS c_mktsegment,
       {_int('balance_text')} AS balance,
       coalesce(upper(trim(active_text)) = 'TRUE', false) AS is_active
FROM ct"""

SQL["clean_reference"] = """
SELECT n_nationkey, trim(' ' || n_name || '  ') AS n_name, trim('  ' || r_name) AS r_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

# ---------------------------------------------------------------- gates

SQL["state_events"] = """
SELECT event_id, user_id, event_type FROM events
WHERE NOT coalesce(event_type IN ('error'), false)"""

SQL["exit_events"] = """
SELECT event_id, user_id, event_type FROM events
WHERE coalesce(event_type IN ('error'), false)"""

SQL["unknown_domain"] = """
SELECT event_type, count(*) AS n FROM events
WHERE NOT coalesce(event_type IN ('view', 'click', 'purchase'), false)
GROUP BY event_type"""

SQL["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

SQL["exactly_one_start"] = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
           FROM events),
p AS (SELECT event_id, user_id, ts,
             CASE WHEN rn = 1 AND user_id % 10 <> 1 THEN 'signup'
                  WHEN rn > 1 AND event_type = 'signup' AND user_id % 10 <> 0 THEN 'view'
                  ELSE event_type END AS event_type
      FROM r)
SELECT user_id, CAST(count_if(event_type = 'signup') AS BIGINT) AS n_start,
       first(event_type ORDER BY ts, event_id) AS first_type
FROM p GROUP BY user_id
HAVING CAST(count_if(event_type = 'signup') AS BIGINT) <> 1
    OR NOT coalesce(first(event_type ORDER BY ts, event_id) = 'signup', false)"""

SQL["gate_summary"] = f"""
WITH {_OT},
od AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 53 = 0
                   THEN -(o_orderkey % 7) - 1 ELSE o_orderkey END AS gk,
              CASE WHEN o_orderkey % 89 <> 2 THEN date_text END AS date_text FROM ot),
pk AS (SELECT gk, gk IS NULL AS nk, count(*) AS n,
              CAST(count_if(date_text IS NOT NULL AND {_parse('date_text')} IS NULL) AS BIGINT) AS bad_date,
              CAST(count_if(date_text IS NULL) AS BIGINT) AS null_date
       FROM od GROUP BY gk)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(CASE WHEN nk THEN n END), 0) AS BIGINT) AS null_keys,
       CAST(count_if(NOT nk AND n > 1) AS BIGINT) AS duplicate_keys,
       CAST(coalesce(sum(bad_date), 0) AS BIGINT) AS bad_date,
       CAST(coalesce(sum(null_date), 0) AS BIGINT) AS null_date
FROM pk"""

SQL["category_distribution"] = """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY event_type"""

SQL["preview_top_n"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date,
       CAST(o_totalprice AS DECIMAL(18,2)) AS price
FROM orders ORDER BY o_orderkey LIMIT 10"""

SQL["chronological_log"] = """
SELECT CAST(o_orderdate AS DATE) AS event_date, o_custkey, o_orderkey,
       row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_custkey, o_orderkey) AS position
FROM orders ORDER BY position"""

# ---------------------------------------------------------------- nested

_NESTED_FROM = """
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

SQL["flatten_struct"] = """
SELECT c.c_custkey, c.c_name AS name, c.c_mktsegment AS segment,
       CASE WHEN c.c_custkey % 10 <> 0 THEN n.n_name END AS nation_name,
       CASE WHEN c.c_custkey % 10 <> 0 THEN r.r_name END AS region_name""" + _NESTED_FROM

SQL["nested_profile"] = """
SELECT count(*) AS n_rows, CAST(count_if(c.c_custkey % 10 = 0) AS BIGINT) AS null_address,
       CAST(count_if(c.c_custkey % 10 = 0 OR r.r_name IS NULL) AS BIGINT) AS null_address_region_name,
       CAST(count_if(c.c_name IS NULL) AS BIGINT) AS null_profile_name""" + _NESTED_FROM

SQL["flag_and_null"] = """
SELECT doc_id, CASE WHEN flag THEN NULL ELSE text END AS text, flag AS text_invalid
FROM (SELECT doc_id, text,
             coalesce(text IS NOT NULL AND NOT regexp_matches(text, '\\d'), false) AS flag
      FROM documents) t"""

_PP = """
pp AS (SELECT page_id,
              CASE WHEN q = '' THEN CAST([] AS STRUCT(key VARCHAR, value VARCHAR)[])
                   ELSE list_transform(string_split(q, '&'),
                        lambda x: {'key': split_part(x, '=', 1), 'value': split_part(x, '=', 2)})
              END AS params
       FROM (SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages) t)"""


def _pick(k: str) -> str:
    return f"list_filter(params, lambda s: s.key = '{k}')[1].value"


SQL["pivot_keyed_array"] = f"""
WITH {_PP}
SELECT page_id, {_pick('page')} AS param_page, {_pick('ref')} AS param_ref,
       {_pick('utm_source')} AS param_utm_source
FROM pp"""

SQL["pivot_pairs"] = """
SELECT conv_id,
       arg_min(text, turn) FILTER (WHERE role = 'system') AS first_system,
       arg_min(text, turn) FILTER (WHERE role = 'user') AS first_user,
       arg_min(text, turn) FILTER (WHERE role = 'assistant') AS first_assistant
FROM conversations GROUP BY conv_id"""

SQL["explode_pairs"] = f"""
WITH {_PP}
SELECT page_id, p.key AS key, p.value AS value
FROM (SELECT page_id, unnest(params) AS p FROM pp) u
UNION ALL
SELECT page_id, NULL AS key, NULL AS value FROM pp WHERE len(params) = 0"""

SQL["first_array_element"] = """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word FROM part"""

SQL["row_count_preserved"] = """
SELECT c_custkey, 1::BIGINT AS n_in, CASE WHEN c_custkey % 150 = 0 THEN 3 ELSE 2 END::BIGINT AS n_out
FROM customer WHERE c_custkey % 50 = 0"""

SQL["sql_nested_probe"] = f"""
WITH {_PP}
SELECT 'empty_params' AS probe, count(*) AS n FROM pp WHERE len(params) = 0
UNION ALL
SELECT 'first_key_known', count(*) FROM pp WHERE params[1].key IN ('page', 'utm_source')
UNION ALL
SELECT 'second_page', count(*) FROM pp WHERE params[1].value = '2'
UNION ALL
SELECT 'multi_params', count(*) FROM pp WHERE len(params) >= 2"""

# ---------------------------------------------------------------- sources

SQL["audit_columns"] = """
SELECT o_orderkey, 'orders.parquet' AS _source_file, true AS has_ingested_at FROM orders"""

_ALL_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()

SQL["table_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, "
    f"CASE WHEN count(*) > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM {t}"
    for t in _ALL_TABLES) + "\nUNION ALL\nSELECT 'employees', NULL, 'MISSING'"

SQL["multi_source_union"] = """
SELECT event_id, user_id,
       CASE event_id % 5 WHEN 0 THEN event_type || ' up' WHEN 1 THEN event_type || '/x:y=%'
                         WHEN 2 THEN NULL ELSE event_type END AS source
FROM events"""

SQL["csv_roundtrip"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_id % 97 <> 3 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_id % 97 <> 3 THEN event_type END AS event_type,
       CASE WHEN event_id % 97 = 3 THEN CAST(event_id AS VARCHAR)
            WHEN event_id % 89 = 4 THEN concat_ws(',', event_id, user_id, event_type, 'extra')
       END AS broken_line
FROM events"""

SQL["json_nested_roundtrip"] = """
SELECT s.s_suppkey, s.s_name, n.n_nationkey AS nation_key, n.n_name AS nation_name,
       n.n_regionkey AS region_key, n.n_name AS tag_nation
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""

SQL["idempotent_overwrite"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"

SQL["source_changes"] = """
WITH cur AS (SELECT c_custkey, md5(concat_ws('||', c_name, c_mktsegment)) AS hh FROM customer),
alt AS (SELECT c_custkey, c_name,
               CASE WHEN c_custkey % 11 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS seg FROM customer),
inc AS (SELECT c_custkey, md5(concat_ws('||', c_name, seg)) AS hh FROM alt WHERE c_custkey % 7 <> 0
        UNION ALL
        SELECT c_custkey + 10000000, md5(concat_ws('||', c_name, seg)) FROM alt WHERE c_custkey % 13 = 0)
SELECT coalesce(cur.c_custkey, inc.c_custkey) AS c_custkey,
       CASE WHEN cur.c_custkey IS NULL THEN 'new' WHEN inc.c_custkey IS NULL THEN 'gone'
            WHEN cur.hh = inc.hh THEN 'unchanged' ELSE 'changed' END AS change,
       cur.hh AS current_hash, inc.hh AS incoming_hash
FROM cur FULL OUTER JOIN inc ON cur.c_custkey = inc.c_custkey"""

SQL["scd2_incremental"] = _HIST + f""",
base_st AS (SELECT * FROM st WHERE valid_from <= DATE '2000-12-31'),
base AS (SELECT o_custkey, valid_from, nx, o_orderstatus, o_orderpriority, price
         FROM (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS nx
               FROM base_st) t),
b AS (SELECT o_custkey, valid_from,
             CASE WHEN nx IS NOT NULL THEN CAST(nx - INTERVAL 1 DAY AS DATE)
                  ELSE coalesce(exit_date, DATE '9999-12-31') END AS valid_to,
             o_orderstatus, o_orderpriority, price, {_ROWHASH} AS row_hash
      FROM base LEFT JOIN ex ON o_custkey = xk),
inc AS (SELECT o_custkey, o_orderstatus, o_orderpriority, price, {_ROWHASH} AS row_hash
        FROM h WHERE DATE '2001-06-30' BETWEEN valid_from AND valid_to),
alive AS (SELECT * FROM b WHERE DATE '2001-07-01' BETWEEN valid_from AND valid_to),
same AS (SELECT alive.o_custkey FROM alive JOIN inc ON alive.o_custkey = inc.o_custkey
         WHERE alive.row_hash = inc.row_hash)
SELECT o_custkey, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current,
       o_orderstatus, o_orderpriority, price, row_hash
FROM b WHERE NOT DATE '2001-07-01' BETWEEN valid_from AND valid_to
          OR o_custkey IN (SELECT o_custkey FROM same)
UNION ALL
SELECT o_custkey, valid_from, DATE '2001-06-30', false, o_orderstatus, o_orderpriority, price, row_hash
FROM alive WHERE o_custkey NOT IN (SELECT o_custkey FROM same) AND valid_from < DATE '2001-07-01'
UNION ALL
SELECT inc.o_custkey, DATE '2001-07-01', coalesce(alive.valid_to, DATE '9999-12-31'),
       coalesce(alive.valid_to, DATE '9999-12-31') = DATE '9999-12-31',
       inc.o_orderstatus, inc.o_orderpriority, inc.price, inc.row_hash
FROM inc LEFT JOIN alive ON inc.o_custkey = alive.o_custkey
WHERE inc.o_custkey NOT IN (SELECT o_custkey FROM same)"""


SQL["reloaded_history"] = SQL["scd2_incremental"].replace(
    "SELECT o_custkey, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current,\n       o_orderstatus",
    ", r AS (SELECT o_custkey, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current,\n       o_orderstatus", 1) + """)
SELECT a.o_custkey, a.valid_from, coalesce(b.valid_to, a.valid_to) AS valid_to,
       coalesce(b.is_current, a.is_current) AS is_current,
       a.o_orderstatus, a.o_orderpriority, a.price, a.row_hash
FROM r a LEFT JOIN r b ON a.o_custkey = b.o_custkey AND a.row_hash = b.row_hash
                      AND a.valid_to = DATE '2001-06-30' AND b.valid_from = DATE '2001-07-01'
WHERE NOT (a.valid_from = DATE '2001-07-01' AND EXISTS (
  SELECT 1 FROM r c WHERE c.o_custkey = a.o_custkey AND c.row_hash = a.row_hash AND c.valid_to = DATE '2001-06-30'))"""

SQL["late_events_spliced"] = SQL["scd2_history"]

SQL["coalesced_history"] = _HIST + """,
marked AS (
  SELECT *, CASE WHEN valid_to >= valid_from
                  AND lag(valid_to) OVER w + INTERVAL 1 DAY = valid_from AND lag(o_orderstatus) OVER w = o_orderstatus
             THEN 0 ELSE 1 END AS opens
  FROM h WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS island FROM marked)
SELECT o_custkey, min(valid_from) AS valid_from, max(valid_to) AS valid_to, max(valid_to) = DATE '9999-12-31' AS is_current,
       arg_min(o_orderkey, valid_from) AS o_orderkey, any_value(o_orderstatus) AS o_orderstatus,
       md5(any_value(o_orderstatus)) AS row_hash
FROM numbered GROUP BY o_custkey, island"""

SQL["bitemporal_asof"] = """
WITH f AS (
  SELECT l_orderkey, l_linenumber, o_custkey, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(CAST(l_shipdate AS DATE) + INTERVAL 30 DAY AS DATE) AS known_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
known AS (SELECT *, CASE WHEN known_day >= DATE '2001-07-01' THEN DATE '9999-12-31'
                         WHEN known_day >= DATE '2000-12-31' THEN DATE '2000-12-31' END AS upto FROM f),
day AS (
  SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
  FROM orders GROUP BY ALL)
SELECT l_orderkey, l_linenumber, o_custkey, ship_date, known_day,
       (SELECT arg_max(day.o_orderstatus, day.d) FROM day
        WHERE day.k = o_custkey AND day.d <= ship_date AND day.d <= upto) AS o_orderstatus
FROM known"""

_USERS = """
WITH e AS (
  SELECT event_id, CASE WHEN event_id % 109 <> 0 THEN user_id END AS user_id,
         CASE WHEN event_id % 107 <> 0 THEN CAST(ts AS DATE) END AS event_day,
         CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'transfer' ELSE event_type END AS event_type
  FROM events),
ok(a, b) AS (VALUES ('signup', 'view'), ('signup', 'click'), ('signup', 'error'), ('view', 'view'), ('view', 'click'),
  ('view', 'purchase'), ('view', 'error'), ('click', 'view'), ('click', 'click'), ('click', 'purchase'), ('click', 'error'),
  ('purchase', 'view'), ('purchase', 'click'), ('purchase', 'error'), ('error', 'signup')),
p AS (
  SELECT *, lag(event_type) OVER w AS previous, row_number() OVER w AS nth
  FROM e WHERE user_id IS NOT NULL AND event_day IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_day, event_id)),
v AS (
  SELECT user_id, event_day, event_id, previous, event_type,
         CASE WHEN event_type IS NULL OR event_type NOT IN ('signup', 'view', 'click', 'purchase', 'error') THEN 'unknown_kind'
              WHEN nth = 1 THEN CASE WHEN event_type <> 'signup' THEN 'not_started' END
              WHEN EXISTS (SELECT 1 FROM ok WHERE a = previous AND b = event_type) THEN NULL
              WHEN event_type = 'signup' THEN 'second_start'
              WHEN previous = 'error' THEN 'after_end'
              ELSE 'bad_transition' END AS violation
  FROM p
  UNION ALL
  SELECT user_id, event_day, event_id, NULL, event_type, CASE WHEN user_id IS NULL THEN 'null_key' ELSE 'null_day' END
  FROM e WHERE user_id IS NULL OR event_day IS NULL)"""

SQL["lifecycle_violations"] = _USERS + " SELECT * FROM v WHERE violation IS NOT NULL"

SQL["lifecycle_counts"] = _USERS + " SELECT " + ", ".join(
    f"count(*) FILTER (violation = '{k}') AS {k}" for k in
    ("null_key", "null_day", "unknown_kind", "not_started", "second_start", "after_end", "bad_transition")) + " FROM v"

SQL["scd2_reject_counts"] = """
SELECT CASE WHEN o_orderkey % 89 = 0 THEN 'null_key' ELSE 'null_day' END AS reason,
       count(*) AS n_events, min(o_orderkey) AS first_order
FROM orders WHERE o_orderkey % 89 = 0 OR o_orderkey % 97 = 0 GROUP BY 1"""

_LAYOUTS = """
WITH e AS (
  SELECT event_id AS k, CAST(event_id AS VARCHAR) AS i, CAST(user_id AS VARCHAR) AS u, event_type AS t,
         'n' || event_id AS note, event_id % 97 = 3 AS short, event_id % 97 <> 3 AND event_id % 89 = 4 AS long FROM events),
l AS (
  SELECT 'event_id,user_id,event_type' AS header, i AS event_id, CASE WHEN NOT short THEN u END AS user_id,
         CASE WHEN NOT short THEN t END AS event_type,
         CASE WHEN short THEN i WHEN long THEN concat_ws(',', i, u, t, 'more') END AS broken_line FROM e WHERE k % 3 = 0
  UNION ALL
  SELECT 'EVENT_TYPE,event_id,user_id', CASE WHEN NOT short THEN i END, CASE WHEN NOT short THEN u END, t,
         CASE WHEN short THEN t WHEN long THEN concat_ws(',', t, i, u, 'more') END FROM e WHERE k % 3 = 1
  UNION ALL
  SELECT 'user_id,event_id,note', CASE WHEN NOT short THEN i END, u, NULL,
         CASE WHEN short THEN u WHEN long THEN concat_ws(',', u, i, note, 'more') END FROM e WHERE k % 3 = 2)"""

SQL["csv_by_header"] = _LAYOUTS + " SELECT event_id, user_id, event_type, broken_line, header FROM l"

SQL["csv_header_report"] = _LAYOUTS + """
SELECT header, CASE WHEN header LIKE '%note' THEN 'event_type' END AS missing,
       CASE WHEN header LIKE '%note' THEN 'note' END AS extra, count(*) AS n_rows, count(broken_line) AS n_broken
FROM l GROUP BY header"""

SQL["variant_fields"] = """
SELECT CASE WHEN whole THEN o_orderkey END AS id, CASE WHEN whole THEN o_orderstatus END AS status,
       CASE WHEN whole THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price,
       CASE WHEN whole AND o_orderkey % 19 <> 0 THEN o_orderpriority END AS priority,
       CASE WHEN whole AND o_orderkey % 19 <> 0 THEN o_custkey END AS customer,
       CASE WHEN whole THEN CAST(o_orderkey AS VARCHAR) END AS tag,
       CASE WHEN NOT whole THEN '{"id":' || o_orderkey END AS broken_line
FROM (SELECT *, o_orderkey % 97 <> 3 AS whole FROM orders) o"""

SQL["json_drift_report"] = """
SELECT path, drift, expected, found, sum(n)::BIGINT AS n FROM (
  SELECT '$' AS path, 'broken' AS drift, 'object' AS expected, 'broken' AS found, 1 AS n FROM orders WHERE o_orderkey % 97 = 3
  UNION ALL SELECT 'channel', 'unknown', NULL, 'string', 1 FROM orders WHERE o_orderkey % 97 <> 3 AND o_orderkey % 7 = 0
  UNION ALL SELECT 'price', 'retyped', 'number', 'string', 1 FROM orders WHERE o_orderkey % 97 <> 3 AND o_orderkey % 11 = 0
  UNION ALL SELECT 'detail.weight', 'unknown', NULL, 'number', 1 FROM orders
            WHERE o_orderkey % 97 <> 3 AND o_orderkey % 13 = 0 AND o_orderkey % 19 <> 0
  UNION ALL SELECT 'tags.[].value', 'retyped', 'string', 'number', 2 FROM orders WHERE o_orderkey % 97 <> 3 AND o_orderkey % 17 = 0)
GROUP BY ALL"""

_LOADS = """
WITH r AS (
  SELECT o_custkey, CASE WHEN year(o_orderdate) < 1999 OR o_orderkey % 4 <> 0 THEN o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2))
              * CASE WHEN year(o_orderdate) >= 1999 THEN 3 ELSE 1 END AS DOUBLE) END AS price,
         CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS DOUBLE) AS order_date, year(o_orderdate) >= 1999 AS late
  FROM orders)"""

SQL["merged_profiles"] = _LOADS + " UNION ALL ".join(
    f" SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null, true AS distinct_close, "
    f"true AS quantiles_close FROM r" for c in ("o_custkey", "o_orderstatus", "price", "order_date"))


def _drift(c: str, ordered: bool) -> str:
    shift = f"""(SELECT max(abs((SELECT count(*) FROM r WHERE NOT late AND {c} <= q) / (SELECT count({c}) FROM r WHERE NOT late)
                       - (SELECT count(*) FROM r WHERE late AND {c} <= q) / (SELECT count({c}) FROM r WHERE late))) > 0.15
             FROM (SELECT unnest(quantile_disc({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS q FROM r WHERE NOT late) t)"""
    return (f" SELECT '{c}' AS \"column\", abs(count(*) FILTER (late AND {c} IS NULL) / count(*) FILTER (late) "
            f"- count(*) FILTER (NOT late AND {c} IS NULL) / count(*) FILTER (NOT late)) > 0.1 AS nulls_changed, "
            f"{shift if ordered else 'false'} AS values_changed FROM r")


SQL["load_drift"] = _LOADS + " UNION ALL ".join(
    _drift(c, c != "o_orderstatus") for c in ("o_custkey", "o_orderstatus", "price", "order_date"))

SQL["ship_working_days"] = """
WITH hol AS (
  SELECT o_orderstatus AS country, CAST(o_orderdate AS DATE) AS d FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderstatus, date_trunc('month', o_orderdate)
                             ORDER BY o_totalprice DESC, o_orderkey DESC) = 1),
work AS (
  SELECT c.country, CAST(g AS DATE) AS d
  FROM (SELECT DISTINCT o_orderstatus AS country FROM orders) c,
       generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2002-12-31', INTERVAL 1 DAY) t(g)
  WHERE dayofweek(g) NOT IN (0, 6) AND NOT EXISTS (SELECT 1 FROM hol WHERE hol.country = c.country AND hol.d = CAST(g AS DATE))),
li AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, o_orderstatus AS country,
         CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
spans AS (SELECT DISTINCT country, order_date, ship_date FROM li),
n AS (SELECT s.country, s.order_date, s.ship_date,
             count(w.d) * CASE WHEN ship_date < order_date THEN -1 ELSE 1 END AS working_days
      FROM spans s LEFT JOIN work w ON w.country = s.country AND w.d > least(s.order_date, s.ship_date)
                                   AND w.d <= greatest(s.order_date, s.ship_date)
      GROUP BY s.country, s.order_date, s.ship_date),
due AS (SELECT s.country, s.order_date, w.d AS due FROM (SELECT DISTINCT country, order_date FROM spans) s
        JOIN work w ON w.country = s.country AND w.d > s.order_date AND w.d <= s.order_date + 40
        QUALIFY row_number() OVER (PARTITION BY s.country, s.order_date ORDER BY w.d) = 5)
SELECT l_orderkey, l_linenumber, ship_date, country, order_date, due, working_days
FROM li JOIN n USING (country, order_date, ship_date) LEFT JOIN due USING (country, order_date)"""
