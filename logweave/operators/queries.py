"""The three aggregate queries.

Each query exists in two DataFrame formulations; ``plans.sql`` holds the SQL
text form.  All three give identical rows.

* ``dataframe``: grouped aggregates.  Catalyst plans partial aggregation
  map-side; an exact distinct count is planned as dedupe on (key, host) then a
  count, so no per-key set is ever held in memory.  Q2 picks its 20 paths by
  count first and counts hosts of these alone.
* ``two_stage``: the dedupe / roll-up written out as two explicit aggregates
  (the mapper-then-reducer shape of the batch engines).

Skew: a key holding a third of all rows is combined map-side before the
shuffle (partial aggregates); for distinct counts the first shuffle is on
(key, host), which spreads a hot key over its hosts.

Ordering: Q1 by (log_date, status_code), Q3 by (log_date, log_hour); Q2 is the
top 20 by request_count descending with ties broken by resource_path
ascending, planned as ``TakeOrderedAndProject`` (no global sort).  Stored results
leave the sort of Q1 and Q3 out (``ordered=False``).  Byte totals are summed exactly;
one that is beyond a long is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.constants import (ERROR_STATUS_MAX, ERROR_STATUS_MIN,
                                TOP_RESOURCES_LIMIT)


def is_error(status: Column | None = None) -> Column:
    """4xx and 5xx responses."""
    status = F.col("status_code") if status is None else status
    return status.between(ERROR_STATUS_MIN, ERROR_STATUS_MAX)


def guarded_rate(num: Column, den: Column) -> Column:
    """Num / den as a double, 0 when den is 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0)).cast("double")


def exact_sum(column: str) -> Column:
    """A sum of longs that cannot overflow: DECIMAL(30, 0)."""
    return F.sum(F.col(column).cast("decimal(20,0)"))


def total_bytes() -> Column:
    """Bytes of a group; NULL where the exact sum is beyond a long."""
    return exact_sum("bytes_transferred").try_cast("long")


def _top(frame: DataFrame) -> DataFrame:
    return frame.orderBy(F.col("request_count").desc(), F.col("resource_path").asc()) \
                .limit(TOP_RESOURCES_LIMIT)


def in_order(result: DataFrame, query: str) -> DataFrame:
    """Stored rows of a query in the query's order."""
    if query == "q2":
        return _top(result)
    return result.orderBy(*result.columns[:2])


# -- dataframe variant --------------------------------------------------------

def q1_daily_traffic(logs: DataFrame, ordered: bool = True) -> DataFrame:
    per_day = logs.groupBy("log_date", "status_code").agg(
        F.count(F.lit(1)).alias("request_count"), total_bytes().alias("total_bytes"))
    return per_day.orderBy("log_date", "status_code") if ordered else per_day


def _late_hosts(logs: DataFrame, per_path: DataFrame, hosts_of) -> DataFrame:
    """The top paths of ``per_path``, then their distinct hosts.

    The 20 rows are broadcast to a second, narrow scan of the logs, so that only the
    (path, host) pairs of these paths are shuffled, not those of every path.
    """
    top = F.broadcast(_top(per_path).withColumnRenamed("resource_path", "top_path"))
    named = logs.select("resource_path", "host").join(
        top, F.col("resource_path").eqNullSafe(F.col("top_path"))).drop("top_path")
    return _top(hosts_of(named))


def q2_top_resources(logs: DataFrame, ordered: bool = True) -> DataFrame:
    per_path = logs.groupBy("resource_path").agg(
        F.count(F.lit(1)).alias("request_count"), total_bytes().alias("total_bytes"))
    return _late_hosts(logs, per_path, lambda named: named.groupBy(
        "resource_path", "request_count", "total_bytes").agg(
        F.count_distinct("host").alias("distinct_host_count")))


def q3_hourly_errors(logs: DataFrame, ordered: bool = True) -> DataFrame:
    err = is_error()
    agg = logs.groupBy("log_date", "log_hour").agg(
        F.count_if(err).alias("error_request_count"),
        F.count(F.lit(1)).alias("total_request_count"),
        F.count_distinct(F.when(err, F.col("host"))).alias("distinct_error_hosts"))
    hourly = agg.select(
        "log_date", "log_hour", "error_request_count", "total_request_count",
        guarded_rate(F.col("error_request_count"), F.col("total_request_count"))
        .alias("error_rate"),
        "distinct_error_hosts")
    return hourly.orderBy("log_date", "log_hour") if ordered else hourly


# -- two_stage variant -------------------------------------------------------

def q1_two_stage(logs: DataFrame, ordered: bool = True) -> DataFrame:
    """Hourly roll-up first, then day totals (re-aggregation by SUM)."""
    hourly = logs.groupBy("log_date", "log_hour", "status_code").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("bytes_transferred").alias("b"))
    per_day = hourly.groupBy("log_date", "status_code").agg(
        F.sum("n").cast("long").alias("request_count"),
        F.sum("b").try_cast("long").alias("total_bytes"))
    return per_day.orderBy("log_date", "status_code") if ordered else per_day


def q2_two_stage(logs: DataFrame, ordered: bool = True) -> DataFrame:
    """Roll up by (path, hour) and then path; dedupe (top path, host), then count."""
    hourly = logs.groupBy("resource_path", "log_date", "log_hour").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("bytes_transferred").alias("b"))
    per_path = hourly.groupBy("resource_path").agg(
        F.sum("n").cast("long").alias("request_count"), F.sum("b").try_cast("long").alias("total_bytes"))
    columns = ["resource_path", "request_count", "total_bytes"]
    return _late_hosts(logs, per_path, lambda named: named.select(*columns, "host").distinct().groupBy(
        *columns).agg(F.count("host").alias("distinct_host_count")))


def q3_two_stage(logs: DataFrame, ordered: bool = True) -> DataFrame:
    """Dedupe (date, hour, host, is_error) with counts, then per hour."""
    per_host = logs.groupBy("log_date", "log_hour", "host",
                            is_error().alias("err")).agg(F.count(F.lit(1)).alias("n"))
    agg = per_host.groupBy("log_date", "log_hour").agg(
        F.sum(F.when(F.col("err"), F.col("n")).otherwise(0)).cast("long")
        .alias("error_request_count"),
        F.sum("n").cast("long").alias("total_request_count"),
        F.count_if(F.col("err")).alias("distinct_error_hosts"))
    hourly = agg.select(
        "log_date", "log_hour", "error_request_count", "total_request_count",
        guarded_rate(F.col("error_request_count"), F.col("total_request_count"))
        .alias("error_rate"),
        "distinct_error_hosts")
    return hourly.orderBy("log_date", "log_hour") if ordered else hourly


DATAFRAME_QUERIES = {"q1": q1_daily_traffic, "q2": q2_top_resources, "q3": q3_hourly_errors}
TWO_STAGE_QUERIES = {"q1": q1_two_stage, "q2": q2_two_stage, "q3": q3_two_stage}
