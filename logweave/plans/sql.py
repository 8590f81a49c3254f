"""SQL formulation of the three queries (F1-F2).

The queries read a view (default ``access_logs``) in the LOG_SCHEMA layout.
Catalyst turns these into the same physical plans as the DataFrame variant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.constants import ERROR_STATUS_MAX, ERROR_STATUS_MIN, TOP_RESOURCES_LIMIT

_ERR = f"status_code BETWEEN {ERROR_STATUS_MIN} AND {ERROR_STATUS_MAX}"

_TOTAL = "try_cast(SUM(CAST(bytes_transferred AS DECIMAL(20, 0))) AS BIGINT) AS total_bytes"

SQL_TEXT = {
    "q1": f"""
SELECT log_date, status_code, COUNT(*) AS request_count, {_TOTAL}
FROM {{view}}
GROUP BY ALL
""",
    "q2": f"""
WITH top AS (
  SELECT resource_path AS top_path, COUNT(*) AS request_count, {_TOTAL}
  FROM {{view}} GROUP BY resource_path
  ORDER BY request_count DESC, top_path LIMIT {TOP_RESOURCES_LIMIT}
)
SELECT /*+ BROADCAST(top) */ resource_path, request_count, total_bytes,
       COUNT(DISTINCT host) AS distinct_host_count
FROM {{view}} JOIN top ON resource_path <=> top_path
GROUP BY resource_path, request_count, total_bytes
ORDER BY request_count DESC, resource_path LIMIT {TOP_RESOURCES_LIMIT}
""",
    "q3": f"""
SELECT log_date, log_hour, error_request_count, total_request_count,
       coalesce(try_divide(error_request_count, total_request_count), 0D) AS error_rate,
       distinct_error_hosts
FROM (
  SELECT log_date, log_hour, COUNT(*) AS total_request_count,
         count_if({_ERR}) AS error_request_count,
         COUNT(DISTINCT host) FILTER (WHERE {_ERR}) AS distinct_error_hosts
  FROM {{view}} GROUP BY log_date, log_hour
)
""",
}
#: the order of a result that is shown; Q2's order picks its rows and is part of it
SQL_ORDER = {"q1": "ORDER BY log_date, status_code", "q2": "", "q3": "ORDER BY log_date, log_hour"}


def sql_query(spark: SparkSession, query: str, view: str = "access_logs",
              ordered: bool = True) -> DataFrame:
    text = SQL_TEXT[query].format(view=view)
    return spark.sql(text + (SQL_ORDER[query] if ordered else ""))
