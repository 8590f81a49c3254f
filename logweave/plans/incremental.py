"""Incremental results: mergeable partials per source file.

Every source (a name and its log files) leaves partial aggregates under
``partials_<query>/log_date=<d>/source=<id>``.  Q1's and Q3's counts merge by sums, Q3's distinct
error hosts by bitmap states (``operators.distinct_state``).  Applying a source again replaces
its partials.  Only the dates that the old or the new version of the source touches are computed
again, from the partials of these dates, and written with dynamic partition overwrite; the
folders of all other dates are left alone.

A failed ``apply`` is repeated: the touched dates are written down before any partial changes and
taken up by the next call, which computes them too.  One writer at a time.

Null log dates do not occur: valid lines have a date.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.parse import parse_lines, valid_rows
from logweave.operators.distinct_state import HostDictionary, distinct_state, merge_states, state_counts
from logweave.operators.queries import exact_sum, guarded_rate, is_error
from logweave.schemas import RESULT_SCHEMAS
from logweave.session import remove_folder, scratch_dir
from logweave.sources.text import read_log_lines

PARTIALS = ("q1", "q3", "hosts")


def source_id(name: str) -> str:
    """A folder name for a source; the letter keeps it from being read as a number."""
    return "s" + hashlib.sha1(name.encode("utf-8")).hexdigest()[:16]


class IncrementalResults:
    """Q1 and Q3 of a growing set of sources, kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.hosts = HostDictionary(spark, f"{self.root}/hosts")

    # -- reads ----------------------------------------------------------------
    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}")
        except AnalysisException as exc:
            if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def results(self, query: str) -> DataFrame:
        """The current rows of ``q1`` or ``q3``."""
        schema, rows = RESULT_SCHEMAS[query], self._read(f"results_{query}")
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def _dates_of(self, name: str, source: str) -> DataFrame | None:
        rows = self._read(name)
        return None if rows is None else rows.filter(F.col("source") == source).select("log_date").distinct()

    # -- writes ---------------------------------------------------------------
    def apply(self, name: str, paths: str | list[str]) -> list:
        """Add or replace a source; the dates that were computed again."""
        logs = valid_rows(parse_lines(read_log_lines(self.spark, paths, missing="fail")))
        staged = scratch_dir(self.spark, "incremental")
        logs.select("host", "log_date", "log_hour", "status_code", "bytes_transferred").write.parquet(staged)
        return self._replace(source_id(name), self.spark.read.parquet(staged), staged)

    def remove(self, name: str) -> list:
        """Take a source out of the results; the dates that were computed again."""
        empty = self.spark.createDataFrame(
            [], "host string, log_date date, log_hour int, status_code int, bytes_transferred long")
        return self._replace(source_id(name), empty, None)

    def _replace(self, source: str, logs: DataFrame, staged: str | None) -> list:
        pending = f"{self.root}/pending"
        touched = logs.select("log_date").distinct()
        for partial in PARTIALS:
            old = self._dates_of(f"partials_{partial}", source)
            touched = touched if old is None else touched.unionByName(old.select(F.col("log_date").cast("date")))
        touched.distinct().coalesce(1).write.mode("append").parquet(pending)
        # a date list is as long as the log's days
        dates = sorted(r[0] for r in self.spark.read.parquet(pending).distinct().collect())

        self.hosts.extend(logs.filter(is_error()))
        fresh = {
            "q1": logs.groupBy("log_date", "status_code").agg(
                F.count(F.lit(1)).alias("request_count"), exact_sum("bytes_transferred").alias("bytes")),
            "q3": logs.groupBy("log_date", "log_hour").agg(
                F.count_if(is_error()).alias("errors"), F.count(F.lit(1)).alias("total")),
            "hosts": distinct_state(logs, ["log_date", "log_hour"], self.hosts, where=is_error()),
        }
        for partial, rows in fresh.items():
            self._drop_source(f"partials_{partial}", source, dates)
            # (log_date, source) folders are this source's alone, so appending cannot meet other rows
            (rows.withColumn("source", F.lit(source)).repartition("log_date")
             .write.mode("append").partitionBy("log_date", "source").parquet(f"{self.root}/partials_{partial}"))
        self._compute(dates)
        remove_folder(self.spark, pending)
        if staged is not None:
            remove_folder(self.spark, staged)
        return dates

    def _drop_source(self, name: str, source: str, dates: list) -> None:
        for date in dates:
            remove_folder(self.spark, f"{self.root}/{name}/log_date={date}/source={source}")

    def _partial(self, name: str, dates: list, schema: str) -> DataFrame:
        """The partials of the touched dates: only their folders are read."""
        rows = self._read(f"partials_{name}")
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows.filter(F.col("log_date").isin(dates))

    def _compute(self, dates: list) -> None:
        q1 = self._partial("q1", dates, "status_code int, request_count long, bytes decimal(30,0), log_date date").groupBy(
            "log_date", "status_code").agg(F.sum("request_count").cast("long").alias("request_count"),
                                           F.sum("bytes").try_cast("long").alias("total_bytes"))
        counts = self._partial("q3", dates, "log_hour int, errors long, total long, log_date date").groupBy(
            "log_date", "log_hour").agg(F.sum("errors").cast("long").alias("error_request_count"),
                                        F.sum("total").cast("long").alias("total_request_count"))
        keys = ["log_date", "log_hour"]
        states = merge_states(self._partial(
            "hosts", dates, "log_hour int, bucket long, bitmap binary, log_date date"), keys)
        q3 = counts.join(state_counts(states, keys, "distinct_error_hosts"), keys, "left").select(
            *keys, "error_request_count", "total_request_count",
            guarded_rate(F.col("error_request_count"), F.col("total_request_count")).alias("error_rate"),
            F.coalesce("distinct_error_hosts", F.lit(0)).alias("distinct_error_hosts"))
        for query, rows in (("q1", q1), ("q3", q3)):
            path = f"{self.root}/results_{query}"
            (rows.repartition("log_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("log_date").parquet(path))
            left = {r[0] for r in rows.select("log_date").distinct().collect()}
            for date in dates:
                if date not in left:                   # the last source of a date is gone
                    remove_folder(self.spark, f"{path}/log_date={date}")
