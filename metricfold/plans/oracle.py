"""Reference SQL for every registered query, runnable by DuckDB on the same tables.

Each statement is a one-shot computation over all rows; the incremental metric
queries must agree with it.  Column names and types are aligned with the Spark
side: DuckDB's BIGINT window ranks and weekdays are cast to INTEGER, HUGEINT
sums to BIGINT.
"""

from __future__ import annotations

# Event types in priority order and their wide columns (as in analogues.py).
REASONS = ["click", "error", "purchase", "signup", "view"]

_CENTS = "CAST(round(value * 100) AS BIGINT)"

DAILY_WIDE = (
    "daily_wide AS (SELECT user_id, CAST(ts AS DATE) AS day, "
    + ", ".join(
        f"CAST(sum(CASE WHEN event_type = '{r}' THEN {_CENTS} END) AS BIGINT) AS {r}_cents"
        for r in REASONS
    )
    + " FROM events GROUP BY user_id, CAST(ts AS DATE))"
)

FIRST_REASON = "CASE " + " ".join(f"WHEN {r}_cents > 0 THEN '{r}'" for r in REASONS) + " END"

ROUTES = """routes AS (
  SELECT s.s_nationkey AS origin, p.p_brand AS carrier, c.c_nationkey AS destination,
         count(*) AS flights
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_tax = 0
  GROUP BY 1, 2, 3)"""

CARRIERS = """carriers AS (
  SELECT origin, carrier, carrier_total,
         CAST(dense_rank() OVER (PARTITION BY origin ORDER BY carrier_total DESC) AS INTEGER)
           AS carrier_rank
  FROM (SELECT origin, carrier, CAST(sum(flights) AS BIGINT) AS carrier_total
        FROM routes GROUP BY 1, 2))"""

DESTINATIONS = """destinations AS (
  SELECT origin, destination, destination_total,
         CAST(dense_rank() OVER (PARTITION BY origin ORDER BY destination_total DESC) AS INTEGER)
           AS destination_rank
  FROM (SELECT origin, destination, CAST(sum(flights) AS BIGINT) AS destination_total
        FROM routes GROUP BY 1, 2))"""


def paired(k: int) -> str:
    """CTEs ``cp``/``dp``: ranks <= k with their position, and ``pairs`` side by side."""
    return f"""cp AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY origin ORDER BY carrier_total DESC, carrier)
                 AS INTEGER) AS position
  FROM carriers WHERE carrier_rank <= {k}),
dp AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY origin ORDER BY destination_total DESC,
                 destination) AS INTEGER) AS position
  FROM destinations WHERE destination_rank <= {k}),
pairs AS (
  SELECT COALESCE(cp.origin, dp.origin) AS origin, COALESCE(cp.position, dp.position) AS position,
         cp.carrier, cp.carrier_total, cp.carrier_rank,
         dp.destination, dp.destination_total, dp.destination_rank
  FROM cp FULL OUTER JOIN dp ON cp.origin = dp.origin AND cp.position = dp.position)"""


TOP_ORIGINS = """
SELECT s.s_nationkey AS origin, n.n_name AS origin_name, count(*) AS departures
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY 1, 2
ORDER BY departures DESC, origin_name, origin
LIMIT 10"""

ON_TIME_SUPPLIERS = """
SELECT l.l_suppkey AS supplier, s.s_name AS supplier_name, count(*) AS on_time
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_discount = 0
GROUP BY 1, 2
ORDER BY on_time DESC, supplier_name, supplier
LIMIT 10"""

ON_TIME_DEPARTURES = f"""
WITH {ROUTES}, {CARRIERS}, {DESTINATIONS}, {paired(3)}
SELECT p.origin, o.n_name AS origin_name, p.position, p.carrier, p.carrier_total, p.carrier_rank,
       p.destination, d.n_name AS destination_name, p.destination_total, p.destination_rank
FROM pairs p
LEFT JOIN nation o ON o.n_nationkey = p.origin
LEFT JOIN nation d ON d.n_nationkey = p.destination"""

MEANS = """
SELECT CAST(isodow(l.l_shipdate) AS INTEGER) AS day_of_week,
       avg(date_diff('day', o.o_orderdate, l.l_shipdate)) AS average_lead
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY 1"""

MEAN_LEAD_TOP = f"SELECT * FROM ({MEANS}) ORDER BY average_lead DESC, day_of_week LIMIT 10"

REASON_COUNTS_TOP = f"""
WITH {DAILY_WIDE}, r AS (SELECT {FIRST_REASON} AS reason FROM daily_wide)
SELECT reason, count(*) AS days FROM r WHERE reason IS NOT NULL GROUP BY reason
ORDER BY days DESC, reason LIMIT 10"""


def _shares(source: str, ctes: str = "") -> str:
    """Percent per reason from a one-row ``source`` of per-reason totals."""
    cols = [f"{r}_cents" for r in REASONS]
    present = " OR ".join(f"{c} IS NOT NULL" for c in cols)
    total = " + ".join(f"COALESCE({c}, 0)" for c in cols)
    union = " UNION ALL ".join(
        f"SELECT '{r}' AS reason, CAST({r}_cents AS DOUBLE) / CAST(NULLIF(total, 0) AS DOUBLE) * 100"
        f" AS percent FROM g" for r in REASONS
    )
    return (f"WITH {ctes}t AS ({source}), g AS (SELECT *, CASE WHEN {present} THEN {total} END AS total"
            f" FROM t) {union}")


TOTALS_FROM_WIDE = (
    f"WITH {DAILY_WIDE} SELECT "
    + ", ".join(f"CAST(sum({r}_cents) AS BIGINT) AS {r}_cents" for r in REASONS)
    + " FROM daily_wide"
)

TOTALS_FROM_EVENTS = "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{r}' THEN {_CENTS} END) AS BIGINT) AS {r}_cents"
    for r in REASONS
) + " FROM events"

SHARE_TOP = f"SELECT * FROM ({_shares(TOTALS_FROM_EVENTS)}) ORDER BY percent DESC, reason LIMIT 10"

SUPPLIER_COUNTS = "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey"

ROUTES_SELECT = f"WITH {ROUTES} SELECT origin, carrier, destination, flights FROM routes"

FULL_JOB = f"""
SELECT 'top_origins' AS metric, origin_name AS key, CAST(departures AS DOUBLE) AS value
FROM ({TOP_ORIGINS})
UNION ALL
SELECT 'on_time_suppliers', supplier_name, CAST(on_time AS DOUBLE) FROM ({ON_TIME_SUPPLIERS})
UNION ALL
SELECT 'on_time_departures', origin_name || '|carrier|' || carrier, CAST(carrier_rank AS DOUBLE)
FROM ({ON_TIME_DEPARTURES}) WHERE carrier IS NOT NULL
UNION ALL
SELECT 'on_time_departures', origin_name || '|destination|' || destination_name,
       CAST(destination_rank AS DOUBLE)
FROM ({ON_TIME_DEPARTURES}) WHERE destination IS NOT NULL
UNION ALL
SELECT 'mean_lead_by_weekday', CAST(day_of_week AS VARCHAR), average_lead FROM ({MEAN_LEAD_TOP})
UNION ALL
SELECT 'first_reason_counts', reason, CAST(days AS DOUBLE) FROM ({REASON_COUNTS_TOP})
UNION ALL
SELECT 'share_by_reason', reason, percent FROM ({SHARE_TOP})"""


ALL_ORIGINS = """
SELECT s.s_nationkey AS origin, n.n_name AS origin_name, count(*) AS departures
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY 1, 2"""


ORACLE: dict[str, str] = {
    "csv_round_trip": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "csv_infer_scan": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "single_file_csv": TOP_ORIGINS,
    "path_lookup": "SELECT count(*) AS row_count FROM supplier",
    "state_lookup": """
SELECT 'top_origins' AS metric_name, CAST(10 AS INTEGER) AS top, 'desc' AS sort_order,
       CAST(min(l_shipdate) AS DATE) AS date_from, CAST(max(l_shipdate) AS DATE) AS date_to
FROM lineitem""",
    "merge_when_no_prior": ALL_ORIGINS,
    "sql_view_top": f"SELECT l_suppkey, n FROM ({SUPPLIER_COUNTS}) ORDER BY n DESC, l_suppkey LIMIT 10",
    "required_columns": "SELECT n_nationkey, n_name FROM nation",
    "date_from_parts": """
SELECT make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS day, count(*) AS n
FROM orders GROUP BY 1""",
    "increment_after": """
SELECT l_suppkey, count(*) AS n FROM lineitem
WHERE CAST(l_shipdate AS DATE) > DATE '1998-12-31' GROUP BY l_suppkey""",
    "increment_null_watermark": SUPPLIER_COUNTS,
    "zero_filter": "SELECT * FROM lineitem WHERE l_discount = 0",
    "project_rename": """
SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_quantity AS quantity,
       l_shipdate AS ship_date FROM lineitem""",
    "alias_qualified": """
SELECT l.l_orderkey, l.l_linenumber, c.n_name AS customer_nation, s.n_name AS supplier_nation
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer cu ON o.o_custkey = cu.c_custkey
JOIN supplier su ON l.l_suppkey = su.s_suppkey
JOIN nation c ON cu.c_nationkey = c.n_nationkey
JOIN nation s ON su.s_nationkey = s.n_nationkey""",
    "first_reason": f"WITH {DAILY_WIDE} SELECT user_id, day, {FIRST_REASON} AS reason FROM daily_wide",
    "drop_nulls": f"WITH {DAILY_WIDE} SELECT * FROM daily_wide WHERE "
                  + " AND ".join(f"{r}_cents IS NOT NULL" for r in REASONS),
    "count_then_name": """
SELECT l.l_suppkey, s.s_name, count(*) AS n
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2""",
    "zero_count_then_name": """
SELECT l.l_suppkey, s.s_name, count(*) AS n
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_discount = 0 GROUP BY 1, 2""",
    "route_counts": ROUTES_SELECT,
    "mean_by_weekday": MEANS,
    "reason_counts": f"""
WITH {DAILY_WIDE}, r AS (SELECT {FIRST_REASON} AS reason FROM daily_wide)
SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""",
    "column_totals": TOTALS_FROM_WIDE,
    "merge_additive": SUPPLIER_COUNTS,
    "merge_routes": ROUTES_SELECT,
    "share_of_total": _shares(
        "SELECT " + ", ".join(f"CAST(sum({r}_cents) AS BIGINT) AS {r}_cents" for r in REASONS)
        + " FROM daily_wide", ctes=DAILY_WIDE + ", "),
    "date_bounds": """
SELECT s_suppkey, s_name,
       (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem) AS min_day,
       (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) AS max_day
FROM supplier""",
    "rank_routes_by_origin": f"""
WITH {ROUTES}
SELECT *, CAST(dense_rank() OVER (PARTITION BY origin ORDER BY flights DESC) AS INTEGER)
          AS origin_rank
FROM routes""",
    "rank_routes_by_destination": f"""
WITH {ROUTES}
SELECT *, CAST(dense_rank() OVER (PARTITION BY destination ORDER BY flights DESC) AS INTEGER)
          AS destination_rank
FROM routes""",
    "top_per_origin": f"""
WITH {ROUTES}, {CARRIERS}
SELECT c.origin, n.n_name AS origin_name, c.carrier, c.carrier_total, c.carrier_rank
FROM carriers c JOIN nation n ON n.n_nationkey = c.origin
WHERE c.carrier_rank <= 10""",
    "top_destinations_per_origin": f"""
WITH {ROUTES}, {DESTINATIONS}
SELECT d.origin, d.destination, n.n_name AS destination_name, d.destination_total,
       d.destination_rank
FROM destinations d JOIN nation n ON n.n_nationkey = d.destination
WHERE d.destination_rank <= 10""",
    "pair_rankings": f"""
WITH {ROUTES}, {CARRIERS}, {DESTINATIONS}, {paired(3)}
SELECT origin, position, carrier, carrier_total, carrier_rank,
       destination, destination_total, destination_rank
FROM pairs""",
    "limit_then_join": f"""
SELECT t.l_suppkey, s.s_name, t.n
FROM (SELECT l_suppkey, n FROM ({SUPPLIER_COUNTS}) ORDER BY n DESC, l_suppkey LIMIT 10) t
JOIN supplier s ON t.l_suppkey = s.s_suppkey""",
    "merge_join_hint": """
SELECT c.c_mktsegment, count(*) AS n
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""",
    "top_n_two_keys": f"""
WITH {ROUTES}, ranked AS (
  SELECT *,
    CAST(dense_rank() OVER (PARTITION BY origin ORDER BY flights DESC) AS INTEGER) AS origin_rank,
    CAST(dense_rank() OVER (PARTITION BY destination ORDER BY flights DESC) AS INTEGER)
      AS destination_rank
  FROM routes)
SELECT * FROM ranked
ORDER BY origin_rank, destination_rank, origin, carrier, destination LIMIT 10""",
    "sorted_means": f"SELECT * FROM ({MEANS}) ORDER BY average_lead",
    "metric_top_origins": TOP_ORIGINS,
    "metric_on_time_suppliers": ON_TIME_SUPPLIERS,
    "metric_on_time_departures": ON_TIME_DEPARTURES,
    "metric_mean_lead_by_weekday": MEAN_LEAD_TOP,
    "metric_first_reason_counts": REASON_COUNTS_TOP,
    "metric_share_by_reason": SHARE_TOP,
    "stream_first_reason_counts": REASON_COUNTS_TOP,
    "stream_keyed_reason_counts": REASON_COUNTS_TOP,
    "stream_replay_after_compaction": REASON_COUNTS_TOP,
    "seeded_merge": ALL_ORIGINS,
    "csv_reordered_columns": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "increment_from_parts": """
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n
FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1996-06-30' GROUP BY 1""",
    "csv_quarantine": """
SELECT CASE WHEN s_acctbal < 0 THEN 'malformed' ELSE 'typed' END AS status, s_suppkey, s_name, s_nationkey,
       CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS s_acctbal
FROM supplier""",
    "late_rows_recount": """
SELECT 'top_origins' AS metric, n_name AS key, count(*) AS n
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_nationkey, n_name
UNION ALL
SELECT 'on_time_suppliers', s_name, count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_discount = 0 GROUP BY s_suppkey, s_name""",
    "store_audit": """
WITH stored AS (SELECT l_suppkey AS supplier, count(*) AS on_time FROM lineitem WHERE l_discount = 0 AND l_linenumber <> 3 GROUP BY 1),
     facts AS (SELECT l_suppkey AS supplier, count(*) AS on_time FROM lineitem WHERE l_discount = 0 GROUP BY 1)
SELECT 'on_time_suppliers' AS metric, 'stored' AS side, * FROM (FROM stored EXCEPT FROM facts)
UNION ALL SELECT 'on_time_suppliers', 'facts', * FROM (FROM facts EXCEPT FROM stored)""",
    "full_recompute": MEAN_LEAD_TOP,
    "full_job": FULL_JOB,
}
