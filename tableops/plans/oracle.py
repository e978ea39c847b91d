"""DuckDB SQL equivalents of the jobs in ``jobs.py`` (the correctness oracle).

Tables are pre-registered views. Money sums go through DECIMAL in both engines so doubles agree exactly;
every output column is aliased and cast to the type the Spark job returns.
"""

from __future__ import annotations

from .jobs import MONTH_LABELS, PIVOT_PART_TYPES, PIVOT_TYPES, RECOGNIZED_COUNTRIES


def _easter(y: str) -> str:
    """Easter Sunday of integer year expression ``y``, by Gauss's rule with its two exceptions."""
    a, k = f"({y} % 19)", f"({y} // 100)"
    m = f"((15 + {k} - {k} // 4 - (8 * {k} + 13) // 25) % 30)"
    n = f"((4 + {k} - {k} // 4) % 7)"
    d = f"((19 * {a} + {m}) % 30)"
    e = f"((2 * ({y} % 4) + 4 * ({y} % 7) + 6 * {d} + {n}) % 7)"
    early = f"CASE WHEN {e} = 6 AND ({d} = 29 OR ({d} = 28 AND {a} > 10)) THEN 7 ELSE 0 END"
    return f"(make_date(CAST({y} AS BIGINT), 3, 22) + CAST({d} + {e} - {early} AS INTEGER))"


def _holiday(d: str, easter: str) -> str:
    """Label of a public holiday: days around Easter first, then fixed days."""
    return f"""CASE {d} - ({easter})
    WHEN 0 THEN 'Easter Sunday' WHEN 1 THEN 'Easter Monday' WHEN -7 THEN 'Palm Sunday' WHEN -3 THEN 'Maundy Thursday'
    WHEN -2 THEN 'Good Friday' WHEN 39 THEN 'Ascension Day' WHEN 49 THEN 'Whit Sunday' WHEN 50 THEN 'Whit Monday'
    ELSE CASE strftime({d}, '%m-%d')
      WHEN '01-01' THEN 'New Year''s day' WHEN '12-31' THEN 'New Year''s eve' WHEN '05-01' THEN 'Labour day'
      WHEN '05-17' THEN 'Constitution day' WHEN '12-24' THEN 'Christmas eve' WHEN '12-25' THEN 'Christmas day'
      WHEN '12-26' THEN 'Boxing day' END END"""


_DATE_DIM = f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
dates AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS nk_date FROM span),
base AS (
  SELECT nk_date,
    CAST(year(nk_date) * 10000 + month(nk_date) * 100 + day(nk_date) AS INTEGER) AS date_number,
    CAST(day(nk_date) AS INTEGER) AS day_month_number,
    CAST(weekofyear(nk_date) AS INTEGER) AS week_number,
    CAST(month(nk_date) AS INTEGER) AS month_number,
    CAST(year(nk_date) AS INTEGER) AS year_number,
    CAST(quarter(nk_date) AS INTEGER) AS quarter_number,
    CAST(isodow(nk_date) AS INTEGER) AS day_of_week,
    CAST(isoyear(nk_date) AS INTEGER) AS year_of_week,
    CAST(date_trunc('month', nk_date) AS DATE) AS first_day_of_month,
    last_day(nk_date) AS last_day_of_month,
    CAST(date_trunc('week', nk_date) AS DATE) AS first_day_of_week,
    CAST(date_trunc('week', nk_date) AS DATE) + 6 AS last_day_of_week,
    CAST(weekofyear(nk_date) AS INTEGER) AS week_of_year,
    CAST(weekofyear(nk_date) AS INTEGER) AS week_iso,
    CAST(day(last_day(nk_date)) AS INTEGER) AS days_in_month,
    7 AS days_in_week,
    CAST(year(nk_date) * 100 + month(nk_date) AS INTEGER) AS year_month_number,
    CAST(year(nk_date) AS VARCHAR) || '-' || CAST(month(nk_date) AS VARCHAR) AS year_month_name,
    CAST(DATE '2001-08-01' - nk_date AS INTEGER) AS relative_day_position,
    CAST((2001 * 12 + 8) - (year(nk_date) * 12 + month(nk_date)) AS INTEGER) AS relative_month_position,
    CAST((2001 * 4 + 3) - (year(nk_date) * 4 + quarter(nk_date)) AS INTEGER) AS relative_quarter_position,
    CAST(2001 - year(nk_date) AS INTEGER) AS relative_year_position,
    CAST((CAST(date_trunc('week', DATE '2001-08-01') AS DATE) - CAST(date_trunc('week', nk_date) AS DATE)) // 7 AS INTEGER) AS relative_week_position,
    CAST(year(nk_date) AS VARCHAR) AS year_name,
    'W ' || CAST(weekofyear(nk_date) AS VARCHAR) AS week_name,
    CAST(isoyear(nk_date) AS VARCHAR) || '-' || CAST(weekofyear(nk_date) AS VARCHAR) AS year_week_name,
    'Q' || CAST(quarter(nk_date) AS VARCHAR) AS quarter_name,
    'Q' || CAST(quarter(nk_date) AS VARCHAR) || right(CAST(year(nk_date) AS VARCHAR), 2) AS year_quarter_name,
    {_easter('year(nk_date)')} AS easter_sunday
  FROM dates),
hol AS (
  SELECT *, {_holiday('nk_date', 'easter_sunday')} AS holiday FROM base),
work AS (
  SELECT *, CASE WHEN holiday IS NOT NULL THEN 0 WHEN day_of_week <= 5 THEN 1 ELSE 0 END AS is_working_day FROM hol)
SELECT * EXCLUDE (easter_sunday),
  CAST(sum(is_working_day) OVER (PARTITION BY year_number, month_number ORDER BY nk_date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS working_day_number,
  CASE WHEN date_trunc('month', nk_date) = DATE '2001-08-01' THEN 'Current month'
       WHEN date_trunc('month', nk_date) = DATE '2001-07-01' THEN 'Last month'
       ELSE year_month_name END AS reporting_month_name,
  CASE WHEN nk_date = DATE '2001-08-01' THEN 'Today' WHEN nk_date = DATE '2001-07-31' THEN 'Yesterday'
       ELSE strftime(nk_date, '%Y-%m-%d') END AS reporting_date
FROM work
"""

_DAILY = """daily AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1)"""

_INTERVALS = """t AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS from_date,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 30 END AS to_date FROM orders)"""

_CUST_TARGET = """target AS (SELECT * FROM customer WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')),
source AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 100 AS DOUBLE) AS c_acctbal, lower(c_mktsegment) AS c_mktsegment
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'))"""

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_QUERY_HISTORY = f"""qh AS (SELECT CAST(event_id AS VARCHAR) AS query_id, 'U' || CAST(user_id AS VARCHAR) AS user_name,
  CASE WHEN event_type = 'error' THEN 'select 1' WHEN event_type = 'signup' THEN 'SELECT ''keep alive'''
       ELSE 'select * from t where k = ' || CAST({_K} AS VARCHAR) END AS query_text,
  CASE WHEN event_type = 'purchase' THEN 'INSERT' ELSE 'SELECT' END AS query_type,
  ts AS end_time FROM events)"""

# access log flattened to (query_id, user_name, query_start_time, object_name, object_domain, ord, columns)
_ACCESS_OBJECTS = f"""ev AS (SELECT event_id, event_type, ts, {_K} AS k FROM events),
objs AS (
  SELECT CAST(event_id AS VARCHAR) AS query_id, 'SYS_' || upper(event_type) AS user_name, ts AS query_start_time,
    'DB1.' || ['S1','S2','S3'][k % 3 + 1] || '.' || ['D_','F_'][k % 2 + 1] || 'T' || CAST(k % 5 AS VARCHAR) AS object_name,
    'Table' AS object_domain, ['C' || CAST(k % 4 AS VARCHAR), 'C' || CAST(k % 6 AS VARCHAR)] AS cols
  FROM ev WHERE event_type <> 'error'
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), 'SYS_' || upper(event_type), ts,
    'DB1.ST.STG_T' || CAST(k % 4 AS VARCHAR),
    CASE WHEN k % 2 = 0 THEN 'Table' ELSE 'View' END,
    CASE WHEN k % 3 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['C0'] END
  FROM ev WHERE event_type <> 'error')"""


def _forecast_sql(metric_name: str, measure: str, value_type: str = "DOUBLE", skip: int = 0) -> str:
    """Long forecast facts; ``skip`` months at the start have no column in the sheet."""
    return f"""
SELECT CAST(c.o_custkey AS VARCHAR) AS center_id, cu.c_name AS center_name, n.n_name AS country_code,
  cu.c_mktsegment AS business_unit, 'U' || c.o_custkey AS unique_id, 'C' || cu.c_nationkey AS currency,
  '1.' || cu.c_nationkey AS currency_rate, '3000' AS account, CASE WHEN c.o_custkey % 10 = 0 THEN 'OH' ELSE 'Club' END AS club_oh,
  strftime(DATE '2001-08-01' - to_months(CAST(cu.c_nationkey AS INTEGER)), '%Y-%m') AS current_fc,
  strftime(m.mo, '%Y-%m') AS period,
  CAST(o.v AS {value_type}) AS value, '2001-08-01' AS extract_date, '{metric_name}' AS metric_name,
  '200008 forecast' AS forecast_file
FROM (SELECT DISTINCT o_custkey FROM orders) c
JOIN customer cu ON cu.c_custkey = c.o_custkey JOIN nation n ON n.n_nationkey = cu.c_nationkey
CROSS JOIN (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)) + INTERVAL {skip} MONTH, max(o_orderdate), INTERVAL 1 MONTH)) AS mo FROM orders) m
LEFT JOIN (SELECT o_custkey, date_trunc('month', o_orderdate) AS mo, {measure} AS v FROM orders GROUP BY 1, 2) o
  ON o.o_custkey = c.o_custkey AND o.mo = m.mo
WHERE n.n_name IN ({", ".join(f"'{c}'" for c in RECOGNIZED_COUNTRIES)})
"""


_SUM_PRICE = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"


def _pivot_cols(column: str = "event_type", values: list[str] = PIVOT_TYPES) -> str:
    return ",\n  ".join(f"CAST(sum(CASE WHEN {column} = '{v}' THEN cnt END) AS BIGINT) AS {v}" for v in values)


# the sale message of an order as JSON, keys of nested objects in order
_WEB_SALE = """o_orderkey, json_object(
    'salesPerson', json_object('externalId', 'emp' || (o_orderkey % 40)),
    'saleType', o_orderpriority,
    'member', json_object('memberId', json_object('clubId', c_nationkey, 'id', c_custkey), 'personId', CAST(c_custkey AS VARCHAR)),
    'recruitmentCode', CASE WHEN o_orderkey % 3 = 0 THEN 'R' || c_nationkey END,
    'membership', json_object('periodPriceAmountInLocalCurrency', CAST(round(o_totalprice) AS BIGINT),
                              'subscriptionId', json_object('clubId', c_nationkey, 'id', o_orderkey)),
    'selections', json_object('productId', json_object('clubId', 1, 'id', o_orderkey % 50)),
    'campaignCode', CASE WHEN o_orderkey % 2 = 0 THEN 'SUMMER' END,
    'brand', c_mktsegment,
    'club', json_object('country', 'N' || c_nationkey),
    'source', 'web',
    'createdAt', strftime(o_orderdate, '%Y-%m-%d'),
    'globalId', 'G' || o_orderkey,
    'payment', json_object('paymentReference', 'P' || o_orderkey),
    'voucher', CASE WHEN o_orderkey % 11 = 0 THEN 'V1' END,
    'clubSalesClubId', c_nationkey,
    'otherPayer', CASE WHEN o_orderstatus = 'F' THEN json_object('email', 'payer' || o_orderkey || '@example.com',
                  'memberId', json_object('clubId', c_nationkey, 'id', o_orderkey % 50)) END) AS j
  FROM orders JOIN customer ON o_custkey = c_custkey"""

ORACLE: dict[str, str] = {
    "top_percent": """
WITH sales AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
    FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01' GROUP BY o_custkey),
firsts AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey),
ranking AS (
  SELECT CAST(dense_rank() OVER (ORDER BY total_spent DESC) AS BIGINT) AS rank,
    substr(c.c_name, 10) AS customer_id, c.c_name AS name, n.n_name AS nation, c.c_mktsegment AS segment,
    CAST(2001 - year(first_order) AS INTEGER) AS tenure_years, total_spent
  FROM sales s JOIN firsts USING (o_custkey) JOIN customer c ON s.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_name LIKE 'Customer#%'),
mr AS (SELECT CAST(max(rank) AS BIGINT) AS max_rank FROM ranking)
SELECT ranking.*, mr.max_rank FROM ranking, mr WHERE rank < max_rank * 0.10
""",
    "duplicate_rows": """
SELECT l.*, d.dup_count FROM lineitem l JOIN (
  SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
) d ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
""",
    "pivot_counts": f"""
WITH raw AS (SELECT user_id, event_type, count(event_id) AS cnt FROM events GROUP BY user_id, event_type)
SELECT user_id,
  {_pivot_cols()}
FROM raw GROUP BY user_id
""",
    "pivot_joined": f"""
WITH raw AS (SELECT l_suppkey, p_type, count(l_orderkey) AS cnt FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT l_suppkey,
  {_pivot_cols("p_type", PIVOT_PART_TYPES)}
FROM raw GROUP BY l_suppkey
""",
    "dimension_orders": f"""
WITH days AS (SELECT CAST(unnest(generate_series(DATE '2001-08-01' - 9999 + INTERVAL 36 MONTH, DATE '2004-08-01', INTERVAL 1 DAY)) AS DATE) AS period),
{_DAILY}
SELECT period, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders, coalesce(revenue, 0.0) AS revenue
FROM days LEFT JOIN daily ON daily.d = days.period
""",
    "last_days": f"""
WITH a AS (SELECT max(CAST(o_orderdate AS DATE)) AS as_of FROM orders),
days AS (SELECT CAST(unnest(generate_series(as_of - INTERVAL 364 DAY, as_of, INTERVAL 1 DAY)) AS DATE) AS period FROM a),
{_DAILY}
SELECT period, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders, coalesce(revenue, 0.0) AS revenue
FROM days LEFT JOIN daily ON daily.d = days.period
""",
    "month_ends": """
WITH a AS (SELECT max(CAST(o_orderdate AS DATE)) AS as_of FROM orders),
ends AS (SELECT last_day(CAST(as_of - to_months(CAST(i AS INTEGER)) AS DATE)) AS period FROM a, range(0, 36) r(i)),
monthly AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS m, count(*) AS n_orders,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1)
SELECT period, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders, coalesce(revenue, 0.0) AS revenue
FROM ends LEFT JOIN monthly ON monthly.m = ends.period
""",
    "week_ends": """
WITH a AS (SELECT max(CAST(o_orderdate AS DATE)) AS as_of FROM orders),
ends AS (SELECT CAST(date_trunc('week', as_of) AS DATE) + 6 - 7 * CAST(i AS INTEGER) AS period FROM a, range(0, 52) r(i)),
weekly AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) + 6 AS w, count(*) AS n_orders,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1)
SELECT period, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders, coalesce(revenue, 0.0) AS revenue
FROM ends LEFT JOIN weekly ON weekly.w = ends.period
""",
    "weekly_snapshots": """
WITH a AS (SELECT min(CAST(o_orderdate AS DATE)) AS s FROM orders),
b AS (SELECT s, CASE WHEN isodow(s) = 1 THEN s ELSE s + CAST(8 - isodow(s) AS INTEGER) END AS first_monday FROM a),
snaps AS (SELECT CAST(unnest(generate_series(first_monday, s + INTERVAL 10 YEAR, INTERVAL 7 DAY)) AS DATE) AS snapshot_date FROM b),
weekly AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS w, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT snapshot_date, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders FROM snaps LEFT JOIN weekly ON weekly.w = snaps.snapshot_date
""",
    "date_dimension": _DATE_DIM,
    "easter_holidays": f"""
WITH {_DAILY},
e AS (SELECT *, {_easter('year(d)')} AS easter_sunday FROM daily),
h AS (SELECT *, {_holiday('d', 'easter_sunday')} AS holiday FROM e),
w AS (SELECT *, CASE WHEN holiday IS NOT NULL THEN 0 WHEN isodow(d) <= 5 THEN 1 ELSE 0 END AS is_working_day FROM h)
SELECT coalesce(holiday, '(none)') AS holiday, is_working_day, CAST(sum(n_orders) AS BIGINT) AS n_orders,
  CAST(count(*) AS BIGINT) AS n_days
FROM w GROUP BY 1, 2
""",
    "working_days": f"""
WITH dim AS ({_DATE_DIM}), {_DAILY}
SELECT year_month_number, CAST(max(working_day_number) AS INTEGER) AS working_days,
  CAST(sum(CASE WHEN is_working_day = 1 THEN n_orders END) AS BIGINT) AS orders_on_working_days,
  CAST(sum(coalesce(n_orders, 0)) AS BIGINT) AS orders
FROM dim LEFT JOIN daily ON dim.nk_date = daily.d GROUP BY year_month_number
""",
    "close_intervals": f"""
WITH {_INTERVALS},
multi AS (SELECT o_custkey FROM t WHERE to_date IS NULL GROUP BY o_custkey HAVING count(*) > 1),
calc AS (SELECT o_orderkey, lead(from_date) OVER (PARTITION BY o_custkey ORDER BY from_date, o_orderkey) - 1 AS next_minus
         FROM t WHERE o_custkey IN (SELECT o_custkey FROM multi))
SELECT t.o_orderkey, t.o_custkey, t.from_date,
  coalesce(CASE WHEN t.to_date IS NULL THEN calc.next_minus END, t.to_date) AS to_date,
  coalesce(t.to_date IS NULL AND calc.next_minus IS NOT NULL, false) AS changed
FROM t LEFT JOIN calc ON t.o_orderkey = calc.o_orderkey
""",
    "update_join": """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
  CASE WHEN c.c_custkey IS NOT NULL AND o.o_orderstatus = 'O' THEN c.c_mktsegment ELSE o.o_orderpriority END AS o_orderpriority
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""",
    "update_defaulted": """
WITH pg AS (SELECT DISTINCT s.s_suppkey, n.n_name, r.r_name
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_name <> 'NATION_0'
  JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_regionkey <> 0)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  CASE WHEN pg.s_suppkey IS NOT NULL AND l.l_shipdate >= TIMESTAMP '1999-01-01' THEN coalesce('FF' || pg.n_name, '-1') ELSE l.l_returnflag END AS l_returnflag,
  CASE WHEN pg.s_suppkey IS NOT NULL AND l.l_shipdate >= TIMESTAMP '1999-01-01' THEN coalesce('FF' || pg.r_name, '-1') ELSE l.l_linestatus END AS l_linestatus,
  l.l_shipdate
FROM lineitem l LEFT JOIN pg ON l.l_suppkey = pg.s_suppkey
""",
    "upsert_full": f"""
WITH {_CUST_TARGET}
SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM source)
UNION ALL SELECT * FROM source
""",
    "merge_partial": f"""
WITH {_CUST_TARGET}
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
  CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE s.c_name END AS c_name,
  CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM target t FULL OUTER JOIN source s ON t.c_custkey = s.c_custkey
""",
    "limit_per_group": """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 5
""",
    "batched_load": """
SELECT o_orderkey, o_orderpriority,
  CAST(floor((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) / 100) AS BIGINT) AS batch
FROM orders
""",
    "json_path": f"""
SELECT event_id, user_id, k, CAST(user_id AS VARCHAR) || 'p' || CAST(k AS VARCHAR) AS member_code
FROM (SELECT event_id, user_id, {_K} AS k FROM events WHERE event_type = 'purchase') WHERE k >= 50
""",
    "event_decode": """
SELECT event_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS event_timestamp_utc,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS member_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS source,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS deviceid
FROM events
""",
    "flatten_array": """
SELECT vec_id, CAST(idx AS INTEGER) AS idx, CAST(v AS DOUBLE) AS value FROM (
  SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS idx, unnest(embedding) AS v FROM embeddings)
WHERE v > 0.2
""",
    "forecast_unpivot": _forecast_sql("total_price", _SUM_PRICE),
    "date_functions": """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d,
  CAST(date_trunc('week', d) AS DATE) AS first_day_of_week,
  CAST(date_trunc('week', d) AS DATE) + 6 AS last_day_of_week,
  d - CAST((isodow(d) + 5) % 7 + 1 AS INTEGER) AS previous_monday,
  last_day(d) AS last_day_of_month,
  CAST(date_trunc('month', d) AS DATE) AS first_day_of_month,
  CAST(date_trunc('year', d) AS DATE) AS first_day_of_year,
  CAST(DATE '2001-08-01' - d AS INTEGER) AS days_to_as_of,
  CAST((CAST(date_trunc('week', DATE '2001-08-01') AS DATE) - CAST(date_trunc('week', d) AS DATE)) // 7 AS INTEGER) AS weeks_to_as_of,
  CAST((2001 * 12 + 8) - (year(d) * 12 + month(d)) AS INTEGER) AS months_to_as_of,
  CAST((2001 * 4 + 3) - (year(d) * 4 + quarter(d)) AS INTEGER) AS quarters_to_as_of,
  CAST(2001 - year(d) AS INTEGER) AS years_to_as_of,
  CAST(isodow(d) AS INTEGER) AS iso_dow,
  CAST(isoyear(d) AS INTEGER) AS iso_year,
  CAST(weekofyear(d) AS INTEGER) AS iso_week,
  CAST(quarter(d) AS INTEGER) AS quarter,
  strftime(d, '%Y/%m/%d/') AS date_path,
  strftime(d, '%Y-%m') AS year_month,
  CAST(d + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
  d + 7 AS plus_week,
  CASE WHEN o_orderstatus = 'F' THEN strftime(d, '%Y-%m-%d') ELSE '2001-07-30' END AS date_or_monday,
  d AS parsed_back,
  d AS from_epoch_micros,
  o_orderdate AS parsed_us_ts,
  CAST(date_trunc('month', d) AS DATE) AS from_parts
FROM o
""",
    "text_functions": """
SELECT p_partkey,
  p_brand || 'p' || CAST(p_partkey AS VARCHAR) AS part_code,
  p_brand || '.' || p_type || '.' || p_name AS fq_name,
  regexp_replace(p_brand, '#.', '', 'g') AS brand_stripped,
  split_part(p_name, ' ', -1) AS last_word,
  split_part(p_brand, '#', 2) AS brand_no,
  substr(p_type, 1, 3) AS type3,
  right(p_brand, 2) AS brand_right2,
  lower(p_type) AS type_lower,
  replace(p_name, ' ', '_') AS name_underscored,
  lower(translate(p_type || '. ' || p_name, ' .', '__')) AS normalised,
  CAST(len(regexp_extract_all(p_name, 'e')) AS INTEGER) AS n_e,
  p_name LIKE 'blue%' AS is_blue,
  regexp_matches(p_name, '^(red|blue) ') AS is_colour,
  'W ' || CAST(p_size AS VARCHAR) AS size_label
FROM part
""",
    "cast_and_math": """
SELECT l_orderkey, l_linenumber,
  CAST(floor(l_quantity / 7) AS BIGINT) AS qty_div7,
  CAST(l_linenumber % 3 AS INTEGER) AS line_mod3,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(20,4)) AS DOUBLE) AS net_price,
  CASE WHEN l_discount > 0.05 THEN 'high' WHEN l_discount > 0.0 THEN 'low' ELSE 'none' END AS discount_band,
  coalesce(CASE WHEN l_tax > 0.0 THEN l_tax END, -1.0) AS tax_or_default,
  CAST(l_quantity AS INTEGER) AS qty_int,
  CAST(l_linenumber AS VARCHAR) AS line_text,
  TRY_CAST(l_returnflag AS INTEGER) AS flag_as_int,
  CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem
""",
    "filters_mix": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus NOT IN ('P')
  AND (o_totalprice > 300000 OR o_orderpriority LIKE '1-%')
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND o_orderdate IS NOT NULL AND regexp_matches(o_orderpriority, '[0-9]-')
""",
    "joins_mix": """
WITH buyers AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
sup AS (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY s_nationkey)
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, CAST(coalesce(sup.n_suppliers, 0) AS BIGINT) AS n_suppliers
FROM buyers c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN sup ON c.c_nationkey = sup.s_nationkey
""",
    "self_join": """
SELECT DISTINCT a.p_name, 'yes' AS in_both
FROM (SELECT p_name FROM part WHERE p_type = 'ECONOMY') a JOIN (SELECT p_name FROM part WHERE p_type = 'SMALL') b USING (p_name)
""",
    "aggs_mix": """
SELECT l_returnflag, l_linestatus, count(*) AS count_order,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base_price,
  max(l_shipdate) AS max_shipdate, min(l_shipdate) AS min_shipdate, max(l_discount) AS max_discount
FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 100
""",
    "top_orders": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10
""",
    "table_usage_search": f"""
WITH {_QUERY_HISTORY}, {_ACCESS_OBJECTS},
cols AS (SELECT query_id, object_name AS accessed_table, unnest(cols) AS column_accessed FROM objs
         WHERE object_name = 'DB1.S1.D_T0' AND object_domain = 'Table'
           AND query_start_time >= TIMESTAMP '2024-01-01' AND user_name IN ('SYS_VIEW'))
SELECT cols.accessed_table, qh.* FROM cols JOIN qh ON cols.query_id = qh.query_id WHERE qh.query_type = 'SELECT'
""",
    "query_search": f"""
WITH {_QUERY_HISTORY}
SELECT * FROM qh WHERE user_name = 'U7' AND query_text NOT IN ('SELECT ''keep alive''', 'select 1') AND query_type = 'SELECT'
ORDER BY end_time DESC
""",
    "column_usage": f"""
WITH {_QUERY_HISTORY}, {_ACCESS_OBJECTS},
cols AS (SELECT query_id, object_name AS accessed_table, unnest(cols) AS column_accessed FROM objs
         WHERE object_name = 'DB1.S2.F_T1' AND object_domain = 'Table'
           AND query_start_time >= TIMESTAMP '2024-01-01' AND user_name IN ('SYS_VIEW', 'SYS_CLICK'))
SELECT cols.accessed_table, qh.* FROM cols JOIN qh ON cols.query_id = qh.query_id
WHERE column_accessed IN ('C1', 'C3') AND qh.query_type = 'SELECT'
""",
    "table_usage": f"""
WITH {_ACCESS_OBJECTS},
inv0 AS (SELECT object_name AS fq, count(*) AS row_count, min(query_start_time) AS created, max(query_start_time) AS last_altered
         FROM objs GROUP BY object_name),
inv AS (SELECT split_part(fq, '.', 1) AS table_catalog, split_part(fq, '.', 2) AS table_schema, split_part(fq, '.', 3) AS table_name,
          row_count, last_altered, created, fq AS fq_table_name FROM inv0
        WHERE regexp_matches(fq, 'DB1\\.(S1|S2|S3)\\.(D|F)_')),
latest AS (SELECT object_name AS fq_table_name, max(query_start_time) AS latest_queried_timestamp FROM objs
           WHERE user_name IN ('SYS_VIEW', 'SYS_CLICK') AND query_start_time >= TIMESTAMP '2024-01-30'
             AND regexp_matches(object_name, 'DB1\\.(S1|S2|S3)\\.(D|F)_') GROUP BY 1),
dup AS (SELECT DISTINCT rp.table_name, 'yes' AS table_exists_in_both FROM inv rp JOIN inv an USING (table_name)
        WHERE rp.table_schema = 'S1' AND an.table_schema = 'S2')
SELECT inv.fq_table_name, inv.table_catalog AS table_database, inv.table_schema, inv.table_name, inv.row_count,
  CAST(inv.last_altered AS DATE) AS last_altered_date, CAST(inv.created AS DATE) AS created_date,
  CASE WHEN greatest(inv.last_altered, inv.created) > TIMESTAMP '2024-01-30' THEN 'yes' ELSE 'no' END AS updated_or_created_last_day,
  CASE WHEN latest.latest_queried_timestamp IS NOT NULL THEN 'yes' ELSE 'no' END AS queried_last_day,
  coalesce(dup.table_exists_in_both, 'no') AS table_exists_in_both
FROM inv LEFT JOIN latest ON inv.fq_table_name = latest.fq_table_name LEFT JOIN dup ON inv.table_name = dup.table_name
WHERE inv.table_schema IN ('S1', 'S2') OR (inv.table_schema = 'S3' AND latest.latest_queried_timestamp IS NOT NULL)
ORDER BY 1, 2, 3, 4
""",
    "freshness": """
WITH u AS (
  SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, max(o_orderdate) AS max_ts FROM orders
  UNION ALL SELECT 'lineitem', 'l_shipdate', max(l_shipdate) FROM lineitem
  UNION ALL SELECT 'events', 'ts', max(ts) FROM events),
meta AS (SELECT * FROM (VALUES ('orders', 'BASE TABLE', TIMESTAMP '2001-08-02'), ('lineitem', 'BASE TABLE', TIMESTAMP '2001-08-02'),
                               ('events', 'VIEW', TIMESTAMP '2024-02-01')) t(table_name, table_type, last_altered))
SELECT u.table_name, u.column_name, u.max_ts, meta.last_altered FROM u JOIN meta ON u.table_name = meta.table_name
WHERE lower(meta.table_type) NOT IN ('view', 'materialized view')
""",
    "freshness_catalog": """
SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, max(o_orderdate) AS max_ts, 'VIEW' AS table_type FROM orders
UNION ALL SELECT 'lineitem', 'l_shipdate', max(l_shipdate), 'VIEW' FROM lineitem
UNION ALL SELECT 'events', 'ts', max(ts), 'VIEW' FROM events
""",
    "weather_enrich": """
WITH w AS (SELECT n_name AS city_name, '2024-01-01T12:00:00Z' AS measure_time, CAST(n_nationkey - 5 AS DOUBLE) AS temperature,
    CASE WHEN n_nationkey * 5 > 50 THEN 'no' ELSE 'yes' END AS clear_sky,
    CASE WHEN n_nationkey % 4 = 3 THEN NULL WHEN n_nationkey * 0.025 > 0.1 THEN 'yes' ELSE 'no' END AS precipitation
  FROM nation WHERE n_regionkey <> 4)
SELECT s.s_suppkey AS center_code, w.measure_time, w.temperature, w.clear_sky, w.precipitation
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN w ON w.city_name = n.n_name
""",
    "schema_evolution": """
SELECT c_custkey, c_name AS customer_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment,
  CAST(NULL AS VARCHAR) AS training_duration FROM customer
""",
    "json_load": f"""
SELECT *, true AS lineage_ok, TIMESTAMP '2001-08-02 06:00:00' AS loaded_at
FROM ({_forecast_sql("total_price", "sum(CAST(o_totalprice AS DECIMAL(18,2)))", "DECIMAL(15,5)")})
""",
    "sheet_forecast": _forecast_sql("total_price", _SUM_PRICE) + " UNION ALL " + _forecast_sql("order_count", "CAST(count(*) AS DOUBLE)", skip=6),
    "event_ingest": """
SELECT event_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS event_timestamp_utc,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS member_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS source,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS deviceid
FROM events
""",
    "unload_reload": """
SELECT CAST(o_orderdate AS DATE) AS scoring_date, 'CU' || CAST(o_custkey AS VARCHAR) AS pk,
  CAST(CAST(o_orderkey % 100000 AS DECIMAL(18,5)) / 100000 AS DECIMAL(6,5)) AS prediction_probability,
  o_orderpriority AS model_name,
  CASE WHEN year(o_orderdate) = 2001 THEN 'v2' ELSE o_orderstatus END AS model_version,
  o_orderdate AS scoring_datetime_utc, true AS lineage_ok, TIMESTAMP '2001-08-02 06:00:00' AS loaded_at
FROM orders
""",
    "delimited_roundtrip": """
SELECT CAST(c_nationkey AS VARCHAR) || 'p' || CAST(c_custkey AS VARCHAR) || 'rpt1' AS agreement_code,
  'CU' || CAST(c_custkey AS VARCHAR) AS member_code, c_mktsegment || ' ÆØÅ' AS person_status,
  DATE '2001-08-01' + c_nationkey AS end_date, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS price
FROM customer
""",
    "incremental_gzip": """
SELECT event_id, ts, user_id, event_type, CASE WHEN ts <= TIMESTAMP '2024-01-22' THEN 1 ELSE 2 END AS round
FROM events WHERE ts > TIMESTAMP '2024-01-15'
""",
    "partial_changed": """
WITH t AS (SELECT c_custkey AS id, c_nationkey AS centerId, 'active' AS lifecycle_tag, CAST(NULL AS VARCHAR) AS past_segment,
    c_mktsegment AS segment, 'flat' AS trend, '1995-01-01' AS lifecycle_start_date, '1995-01-01' AS segment_start_date,
    '1995-01-01' AS changeddate, c_name AS name FROM customer),
s0 AS (SELECT c_custkey, c_nationkey AS centerId, 'churn_risk' AS lifecycle_tag, c_mktsegment AS past_segment,
    lower(c_mktsegment) AS segment, CASE WHEN c_acctbal < -500 THEN 'down' ELSE 'stable' END AS trend,
    '2001-08-01' AS lifecycle_start_date, '2001-08-01' AS segment_start_date, '2001-08-01' AS changeddate, c_acctbal FROM customer),
s AS (SELECT c_custkey AS id, * EXCLUDE (c_custkey, c_acctbal) FROM s0 WHERE c_acctbal < 0
      UNION ALL SELECT c_custkey + 1000000 AS id, * EXCLUDE (c_custkey, c_acctbal) FROM s0 WHERE c_acctbal > 9000
      UNION ALL SELECT c_custkey AS id, * EXCLUDE (c_custkey, c_acctbal) REPLACE (centerId + 1 AS centerId) FROM s0
      WHERE c_acctbal BETWEEN 5000 AND 6000)
SELECT coalesce(t.id, s.id) AS id,
  CASE WHEN t.id IS NOT NULL THEN t.centerId ELSE s.centerId END AS centerId,
  CASE WHEN s.id IS NOT NULL THEN s.lifecycle_tag ELSE t.lifecycle_tag END AS lifecycle_tag,
  CASE WHEN s.id IS NOT NULL THEN s.past_segment ELSE t.past_segment END AS past_segment,
  CASE WHEN s.id IS NOT NULL THEN s.segment ELSE t.segment END AS segment,
  CASE WHEN s.id IS NOT NULL THEN s.trend ELSE t.trend END AS trend,
  CASE WHEN s.id IS NOT NULL THEN s.lifecycle_start_date ELSE t.lifecycle_start_date END AS lifecycle_start_date,
  CASE WHEN s.id IS NOT NULL THEN s.segment_start_date ELSE t.segment_start_date END AS segment_start_date,
  CASE WHEN s.id IS NOT NULL THEN s.changeddate ELSE t.changeddate END AS changeddate,
  CASE WHEN t.id IS NOT NULL THEN t.name END AS name
FROM t FULL OUTER JOIN s ON t.id = s.id AND t.centerId = s.centerId
""",
    "batch_commit": """
SELECT o_orderkey AS id, c_nationkey AS centerId, o_orderpriority AS segment, o_orderstatus AS lifecycle_tag,
  strftime(o_orderdate, '%Y-%m-%d') AS changeddate,
  (row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) - 1) // 100 AS batch
FROM orders JOIN customer ON o_custkey = c_custkey
""",
    "freshness_footers": """
SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, CAST(max(o_orderdate) AS TIMESTAMP) AS max_ts,
  TIMESTAMP '2001-08-02' AS last_altered, count(*) AS n_rows FROM orders
UNION ALL
SELECT 'lineitem', 'l_shipdate', CAST(max(l_shipdate) AS TIMESTAMP), TIMESTAMP '2001-08-02', count(*) FROM lineitem
""",
    "running_totals": """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS finished_by FROM orders)
SELECT * EXCLUDE (finished_by), count(*) OVER w AS orders_so_far, CAST(sum(cents) OVER w AS BIGINT) AS cents_so_far,
  max(cents) OVER w AS largest_so_far, last_value(finished_by IGNORE NULLS) OVER w AS last_finished_by,
  CAST(sum(cents) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS customer_cents_so_far
FROM o WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
    "tie_safe_extract": """
WITH e AS (SELECT event_id, date_trunc('hour', ts) AS hour, user_id, event_type FROM events)
SELECT *, CAST(CASE
    WHEN hour < TIMESTAMP '2024-01-10 07:00:00' OR (hour = TIMESTAMP '2024-01-10 07:00:00' AND event_id % 2 = 0) THEN 1
    WHEN hour < TIMESTAMP '2024-01-20 13:00:00' OR (hour = TIMESTAMP '2024-01-20 13:00:00' AND event_id % 2 = 0) THEN 2
    ELSE 3 END AS INTEGER) AS extract
FROM e
""",
    "schema_generations": """
SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1998 THEN 'C' ELSE '' END || o_custkey AS customer,
  CAST(CASE WHEN year(o_orderdate) > 1998 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(11,1))
       ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(14,4)) AS price,
  CASE WHEN year(o_orderdate) > 1998 THEN CAST(o_orderdate AS TIMESTAMP) ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS day,
  CASE WHEN year(o_orderdate) >= 1996 THEN o_orderpriority END AS o_orderpriority
FROM orders
""",
    "event_capture": """
SELECT event_id, CAST(event_id * 96 AS VARCHAR) AS "offset", ts AS enqueued_at,
  CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS event_timestamp_utc,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS member_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS source,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS deviceid
FROM events
""",
    "partition_merge": """
WITH t AS (SELECT c_custkey AS id, c_nationkey AS centerId, 'active' AS lifecycle_tag, CAST(NULL AS VARCHAR) AS past_segment,
    c_mktsegment AS segment, 'flat' AS trend, '1995-01-01' AS lifecycle_start_date, '1995-01-01' AS segment_start_date,
    '1995-01-01' AS changeddate FROM customer),
s0 AS (SELECT c_custkey, c_nationkey AS centerId, 'churn_risk' AS lifecycle_tag, c_mktsegment AS past_segment,
    lower(c_mktsegment) AS segment, CASE WHEN c_acctbal < -500 THEN 'down' ELSE 'stable' END AS trend,
    '2001-08-01' AS lifecycle_start_date, '2001-08-01' AS segment_start_date, '2001-08-01' AS changeddate, c_acctbal FROM customer),
s AS (SELECT * FROM (SELECT c_custkey AS id, * EXCLUDE (c_custkey, c_acctbal) FROM s0 WHERE c_acctbal < 0
      UNION ALL SELECT c_custkey + 1000000 AS id, * EXCLUDE (c_custkey, c_acctbal) FROM s0 WHERE c_acctbal > 9000
      UNION ALL SELECT c_custkey AS id, * EXCLUDE (c_custkey, c_acctbal) REPLACE (centerId + 1 AS centerId) FROM s0
      WHERE c_acctbal BETWEEN 5000 AND 6000) WHERE centerId % 5 = 2),
m AS (SELECT * FROM s UNION ALL SELECT * FROM t ANTI JOIN s USING (id, centerId))
SELECT *, centerId NOT IN (SELECT centerId FROM s) AS file_kept FROM m
""",
    "streaming_upsert": """
SELECT CAST(user_id % 16 AS INTEGER) AS shard, user_id, ts, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""",
    "composite_codes": """
SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS contact_code,
  CAST(c_nationkey AS VARCHAR) || 'p' || CAST(c_custkey AS VARCHAR) AS member_code,
  CAST(c_nationkey AS VARCHAR) || 'ss' || CAST(o_orderkey AS VARCHAR) AS subscription_id,
  '1prod' || CAST(o_orderkey % 50 AS VARCHAR) AS product_id,
  o_orderpriority AS sale_type,
  'payer' || CAST(o_orderkey AS VARCHAR) || '@example.com' AS otherpayer_email,
  CAST(c_nationkey AS VARCHAR) AS c_id,
  CAST(c_nationkey AS VARCHAR) || 'p' || CAST(o_orderkey % 50 AS VARCHAR) AS otherpayer_membercode
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
""",
    "variant_flatten": f"""
WITH p AS (SELECT {_WEB_SALE}),
f AS (SELECT o_orderkey, j, unnest(json_keys(j)) AS field FROM p),
k AS (SELECT o_orderkey, field, json_extract(j, '$."' || field || '"') AS v FROM f)
SELECT o_orderkey, CAST(NULL AS INTEGER) AS idx, field, CAST(v AS VARCHAR) AS value,
  CASE json_type(v) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'scalar' END AS value_kind
FROM k WHERE json_type(v) <> 'NULL'
""",
    "web_sale_load": """
SELECT o_orderkey, 'emp' || (o_orderkey % 40) AS salesperson_externalid, o_orderpriority AS sale_type,
  CAST(c_custkey AS VARCHAR) AS contact_code, c_nationkey || 'p' || c_custkey AS member_code,
  CASE WHEN o_orderkey % 3 = 0 THEN 'R' || c_nationkey END AS recruitmentcode,
  c_nationkey || 'ss' || o_orderkey AS subscription_id, '1prod' || (o_orderkey % 50) AS product_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'SUMMER' END AS campaign_code, c_mktsegment AS brand, 'N' || c_nationkey AS country,
  'web' AS source, strftime(o_orderdate, '%Y-%m-%d') AS createddate, 'G' || o_orderkey AS global_id,
  CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS period_price, 'P' || o_orderkey AS payment_reference,
  CASE WHEN o_orderkey % 11 = 0 THEN 'V1' END AS voucher, CAST(c_nationkey AS VARCHAR) AS clubsalesclubid,
  true AS lineage_ok, TIMESTAMP '2001-08-02 06:00:00' AS loaded_at
FROM orders JOIN customer ON o_custkey = c_custkey
""",
    "web_sale_search": """
SELECT o_orderkey, 'payer' || o_orderkey || '@example.com' AS otherpayer_email, '7' AS clubid, '32' AS id,
  '7p32' AS otherpayer_membercode, CAST(c_custkey AS VARCHAR) AS m_id, '7' AS c_id, '7p' || c_custkey AS membercode
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND c_nationkey = 7 AND o_orderkey % 50 = 32
""",
    "json_array_load": """
SELECT c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM customer
""",
    "json_array_split": r"""
SELECT o_orderkey, o_custkey, '{"a, [b]\' || o_orderpriority || '\\"}, {' AS remark FROM orders
""",
    "date_path_scan": """
SELECT event_id, ts, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-11'
""",
    "insert_select": """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders
""",
    "array_code_lookup": """
SELECT nk_contact, CAST(idx AS INTEGER) AS idx, code FROM (
  SELECT 'CU' || CAST(c_custkey AS VARCHAR) AS nk_contact,
    unnest([CAST(c_nationkey AS VARCHAR) || 'p' || CAST(c_custkey AS VARCHAR), lower(c_mktsegment) || CAST(c_custkey AS VARCHAR),
            'old' || CAST(c_custkey % 7 AS VARCHAR)]) AS code,
    unnest([0, 1, 2]) AS idx
  FROM customer) WHERE starts_with(code, '1p')
""",
    "keyed_bulk_load": """
WITH src AS (SELECT o_orderkey AS id, c_nationkey AS centerId, o_orderpriority AS segment, o_orderstatus AS lifecycle_tag,
    strftime(o_orderdate, '%Y-%m-%d') AS changeddate, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey),
old AS (SELECT id, centerId, segment, 'stale' AS lifecycle_tag, changeddate FROM src WHERE o_orderdate < TIMESTAMP '1998-01-01'),
store AS (SELECT * FROM old UNION ALL SELECT * REPLACE (centerId + 100 AS centerId) FROM old WHERE id % 7 = 0)
SELECT * FROM store ANTI JOIN src USING (id, centerId) UNION ALL SELECT * EXCLUDE (o_orderdate) FROM src
""",
    "incremental_extract": """
SELECT event_id, ts, user_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15'
""",
    "date_or_monday": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') ELSE '2001-07-30' END AS scoring_date
FROM orders
""",
}
