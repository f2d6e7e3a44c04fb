"""SQL text of the run-shaped views, for the DuckDB oracle side.

The Spark side builds the same views with the DataFrame API
(:mod:`loadlens.sources.tables`).  Each oracle query is prefixed with the
CTEs it needs via :func:`with_views`.
"""

from __future__ import annotations

VIEWS = {
    "order_runs": """
WITH l AS (
  SELECT l_orderkey,
         CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) * 10 AS total_requests,
         CAST(sum(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09
                       THEN CAST(floor(l_quantity) AS BIGINT) ELSE 0 END) AS BIGINT) AS total_failures,
         avg(l_extendedprice) / 50 AS avg_response_time,
         max(l_extendedprice) / 50 AS max_response_time,
         min(l_extendedprice) / 50 AS min_response_time,
         avg(l_discount) AS d, avg(l_tax) AS x
  FROM lineitem GROUP BY l_orderkey)
SELECT concat('test_', CAST(o_orderkey AS VARCHAR)) AS test_id,
       CASE o_orderstatus WHEN 'F' THEN 'api' WHEN 'O' THEN 'frontend' ELSE 'load' END AS test_type,
       o_orderdate AS ts, total_requests, total_failures,
       CAST(total_failures AS DOUBLE) / nullif(total_requests, 0) AS error_rate,
       avg_response_time, max_response_time, min_response_time,
       CAST(total_requests AS DOUBLE) / (60 * (1 + o_custkey % 40)) AS requests_per_sec,
       10 + CAST(floor(o_totalprice) AS BIGINT) % 591 AS concurrent_users,
       CAST(1 + o_custkey % 25 AS DOUBLE) AS spawn_rate,
       CAST(60 * (1 + o_custkey % 40) AS BIGINT) AS duration,
       CASE o_custkey % 4 WHEN 0 THEN 'wifi' WHEN 1 THEN '4g' WHEN 2 THEN '3g' ELSE 'slow_3g' END AS network_condition,
       CASE WHEN o_orderstatus = 'O' THEN CASE o_orderkey % 4 WHEN 0 THEN 'chrome' WHEN 1 THEN 'firefox'
            WHEN 2 THEN 'safari' ELSE 'edge' END END AS browser,
       CASE WHEN o_orderstatus = 'O' THEN 1 - d * 5 END AS performance_score,
       CASE WHEN o_orderstatus = 'O' THEN 1 - x * 3 END AS accessibility_score,
       CASE WHEN o_orderstatus = 'O' THEN 1 - d * 2 END AS best_practices_score,
       CASE WHEN o_orderstatus = 'O' THEN 1 - x END AS seo_score,
       CASE WHEN o_orderkey % 50 = 0 THEN 'error' ELSE 'success' END AS status
FROM orders JOIN l ON l_orderkey = o_orderkey""",
    "hourly_runs": """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS total_requests,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS total_failures,
  avg(value) AS avg_response_time, max(value) AS max_response_time, min(value) AS min_response_time,
  count(*) / 3600.0E0 AS requests_per_sec, count(DISTINCT user_id) AS concurrent_users
FROM events GROUP BY date_trunc('hour', ts)""",
    "request_stats": """
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS request_count,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failure_count,
  avg(value) AS avg_response_time, max(value) AS max_response_time, min(value) AS min_response_time,
  count(*) / 3600.0E0 AS requests_per_sec,
  concat('hour_', strftime(date_trunc('hour', ts), '%Y%m%d%H')) AS test_id
FROM events GROUP BY date_trunc('hour', ts), event_type""",
    "baseline_runs": "SELECT * FROM order_runs WHERE ts < TIMESTAMP '1999-01-01 00:00:00'",
    "current_runs": """
SELECT * REPLACE (avg_response_time * 1.5E0 AS avg_response_time)
FROM order_runs WHERE ts >= TIMESTAMP '1999-01-01 00:00:00'""",
    "order_configs": """
SELECT concat('test_', CAST(l_orderkey AS VARCHAR)) AS test_id,
       list_sort(list(DISTINCT concat('/api/', lower(l_returnflag), '/', lower(l_linestatus)))) AS api_endpoints,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL
            ELSE CAST(sum(CAST(floor(l_quantity) AS BIGINT)) * 100 AS BIGINT) END AS payload_size
FROM lineitem GROUP BY l_orderkey""",
    "class_predictions": """
SELECT doc_id, CAST(quality AS DOUBLE) AS actual, CAST(toxic AS DOUBLE) AS predicted FROM labels""",
    "reg_predictions": """
SELECT l_orderkey, l_linenumber, l_shipdate, 'a' AS model, l_extendedprice AS actual, 2100 * l_quantity AS predicted
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_shipdate, 'b' AS model, l_extendedprice AS actual, 50000.0E0 AS predicted
FROM lineitem""",
}

# views that refer to other views
DEPENDS = {"baseline_runs": ["order_runs"], "current_runs": ["order_runs"]}


def with_views(sql: str, *names: str) -> str:
    ordered: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)
    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    if not ordered:
        return sql
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
