"""

Every registered query reads the driver tables (``events``; ``orders`` for
multi-year dates and ISO year-boundary weeks), turns them into access-log text
files (``logweave.sources.fixtures``) and runs the engine on those files over
the whole tables.  Each oracle computes the same answer in DuckDB directly
from the tables, without parsing a line.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable
from functools import reduce

# importable when this file is loaded by path from another working directory
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from logweave.__main__ import _batch_size
from logweave.functions.batchkeys import calendar_key
from logweave.functions.parse import parse_lines, valid_rows
from logweave.operators.batching import batch_stats, run_stats
from logweave.operators.distinct_state import (HostDictionary, distinct_state, merge_states,
                                               state_counts, state_members)
from logweave.operators.compare import (compare_all_pairs, compare_runs,
                                        compare_summary, diff_examples)
from logweave.operators.queries import (is_error, q1_daily_traffic, q1_two_stage,
                                        q2_top_resources, q2_two_stage,
                                        q3_hourly_errors, q3_two_stage)
from logweave.plans.incremental import IncrementalResults
from logweave.plans.job import parse_for_staging, run_all, run_job
from logweave.plans.report import (report_batches, report_q1, report_q2,
                                   report_q3, run_report, write_report)
from logweave.plans.sql import sql_query
from logweave.schemas import LOG_COLUMNS
from logweave.session import app_id, scratch_dir
from logweave.sinks.store import (ResultStore, jdbc_frame, stage_parquet, stage_tsv,
                                  write_tsv_output)
from logweave.sources.fixtures import (event_log_lines, fixture_log_dir, set_arrival_order,
                                      write_log_files)
from logweave.sources.staged import (read_query_output, read_ranked_output, read_staged_tsv,
                                     register_external_table, typed_tsv)
from logweave.sources.text import read_log_lines
from logweave.streaming.ingest import stream_ingest

FIXED_BATCH = 500          # fixed batch size of the registered batch queries
RUN_PREFIX = "r1"          # run ids of the registered store queries


# -- shared inputs --------------------------------------------------------------

def _lines(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return read_log_lines(spark, [fixture_log_dir(spark, sf_dir, table)])


def _parsed(spark, sf_dir, table="events") -> DataFrame:
    return parse_lines(_lines(spark, sf_dir, table))


def _logs(spark, sf_dir, table="events") -> DataFrame:
    return valid_rows(_parsed(spark, sf_dir, table))


def _staged(spark, sf_dir, table="events") -> DataFrame:
    """Parsed rows with batch date and input position (not written)."""
    return parse_for_staging(_lines(spark, sf_dir, table))


_STORES: dict[tuple, tuple] = {}


def _store_runs(spark: SparkSession, sf_dir: str):
    """Three variant runs of the events logs appended to one store (per session)."""
    key = (app_id(spark), os.path.abspath(sf_dir))
    if key not in _STORES:
        store = ResultStore(spark, scratch_dir(spark, "store"))
        runs = run_all(spark, [fixture_log_dir(spark, sf_dir)], store, strategy="fixed",
                       batch_size=FIXED_BATCH, run_prefix=RUN_PREFIX)
        _STORES[key] = (store, [r.run_id for r in runs])
    return _STORES[key]


# -- registered queries ---------------------------------------------------------

def q_parse_valid_rows(spark, sf_dir):
    return _logs(spark, sf_dir)


def q_parse_malformed_rows(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return staged.filter("is_malformed").select(F.col("malformed_line").alias("line"))


def q_parse_status_counts(spark, sf_dir):
    return _parsed(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(~F.col("is_malformed")).alias("valid_lines"),
        F.count_if(F.col("is_malformed")).alias("malformed_lines"))


def q_request_parts(spark, sf_dir):
    return _logs(spark, sf_dir, "orders").groupBy(
        "http_method", "resource_path", "protocol_version").agg(
        F.count(F.lit(1)).alias("request_count"))


def q_bytes_normalised(spark, sf_dir):
    return _logs(spark, sf_dir).groupBy("status_code").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if(F.col("bytes_transferred") == 0).alias("zero_byte_requests"),
        F.sum("bytes_transferred").cast("long").alias("total_bytes"),
        F.min("bytes_transferred").alias("min_bytes"),
        F.max("bytes_transferred").alias("max_bytes"))


def _sql_variant(query):
    def run(spark, sf_dir):
        _logs(spark, sf_dir).createOrReplaceTempView("access_logs")
        return sql_query(spark, query, "access_logs")
    return run


def _batch(strategy, table="events", batch_size=FIXED_BATCH):
    def run(spark, sf_dir):
        return batch_stats(_staged(spark, sf_dir, table), strategy, batch_size)
    return run


def q_batch_malformed_key(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return staged.filter("is_malformed").select(
        F.col("malformed_line").alias("line"),
        calendar_key("monthly", F.col("batch_date")).alias("month_key"),
        calendar_key("weekly", F.col("batch_date")).alias("week_key"))


def q_run_stats(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    parts = [run_stats(batch_stats(staged, "fixed", FIXED_BATCH), "fixed", FIXED_BATCH),
             run_stats(batch_stats(staged, "monthly"), "monthly", 10000),
             run_stats(batch_stats(staged, "weekly"), "weekly", 10000)]
    return reduce(DataFrame.unionByName, parts)


def q_stage_tsv_roundtrip(spark, sf_dir):
    path = stage_tsv(_logs(spark, sf_dir), scratch_dir(spark, "stage-tsv"))
    return read_staged_tsv(spark, path)


def q_stage_parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "stage-parquet")
    _logs(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path).select(*LOG_COLUMNS)


def q_external_table_scan(spark, sf_dir):
    path = stage_tsv(_logs(spark, sf_dir), scratch_dir(spark, "stage-ext"))
    register_external_table(spark, path, "access_logs_ext")
    return spark.sql("SELECT * FROM access_logs_ext")


def q_query_output_roundtrip(spark, sf_dir):
    path = write_tsv_output(q3_hourly_errors(_logs(spark, sf_dir)),
                            scratch_dir(spark, "q3-out"))
    return read_query_output(spark, path, "q3")


def q_result_append_by_run(spark, sf_dir):
    store = ResultStore(spark, scratch_dir(spark, "append-store"))
    paths = [fixture_log_dir(spark, sf_dir)]
    for _ in range(2):      # the same run id twice: replaced, not duplicated
        run_job(spark, paths, "fixed", FIXED_BATCH, "1", "dataframe", store,
                "dataframe", "run_a")
    run_job(spark, paths, "fixed", FIXED_BATCH, "1", "sql", store, "sql", "run_b")
    return store.results("q1", "run_a").select(
        "pipeline_name", "run_id", "batch_id", "log_date", "status_code",
        "request_count", "total_bytes")


def q_run_metadata_sink(spark, sf_dir):
    store, runs = _store_runs(spark, sf_dir)
    return store.run_metadata().filter(F.col("run_id").isin(runs)).select(
        "run_id", "pipeline_name", "batch_strategy", "batch_size", "total_records",
        "malformed_records", "num_batches", "avg_batch_size")


def q_batch_metadata_sink(spark, sf_dir):
    store, runs = _store_runs(spark, sf_dir)
    return store.batch_metadata(runs[0]).select(
        "pipeline_name", "run_id", "batch_sequence", "batch_key", "batch_strategy",
        "total_records", "valid_records", "malformed_records")


def _report(fn):
    def run(spark, sf_dir):
        store, runs = _store_runs(spark, sf_dir)
        return fn(store, runs[0])
    return run


def _compare(query):
    def run(spark, sf_dir):
        store, runs = _store_runs(spark, sf_dir)
        return compare_runs(store, runs[0], runs[1], query)
    return run


def q_compare_q1_mixed_inputs(spark, sf_dir):
    """Run A reads the events logs, run B the events and orders logs: Q1 keys of
    the events match, the orders' (disjoint dates) are only in B."""
    store = ResultStore(spark, scratch_dir(spark, "mixed-store"))
    events, orders = fixture_log_dir(spark, sf_dir), fixture_log_dir(spark, sf_dir, "orders")
    run_job(spark, [events], "monthly", queries="1", store=store, run_id="events_only")
    run_job(spark, [events, orders], "monthly", queries="1", store=store, run_id="both")
    return compare_runs(store, "events_only", "both", "q1")


def q_compare_summary(spark, sf_dir):
    store, runs = _store_runs(spark, sf_dir)
    return compare_summary(store, runs[0], runs[2])


def q_compare_all_pairs(spark, sf_dir):
    store, runs = _store_runs(spark, sf_dir)
    return compare_all_pairs(store, runs)


def q_selected_queries_job(spark, sf_dir):
    job = run_job(spark, [fixture_log_dir(spark, sf_dir)], "monthly", queries="1,3")
    return reduce(DataFrame.unionByName, [
        frame.agg(F.lit(q).alias("query"), F.count(F.lit(1)).alias("result_rows"))
        for q, frame in job.results.items()])


SMALL_BATCH = 20           # more than 50 batches at every scale
LONG = "p" * 600           # makes a path longer than any column


def _event_files(spark, sf_dir, name, change=None, keep=None) -> str:
    """The events logs with a rule applied to events (keep) or lines (change), as files."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")

    def build(rows):
        lines = event_log_lines(rows)
        return lines if change is None else lines.withColumn("line", change(F.col("line")))

    return write_log_files(events.filter(keep) if keep else events, "event_id",
                           scratch_dir(spark, f"logs-{name}"), build=build)


def _long_path_lines(line):
    """Every request path gets a first part of 600 characters."""
    return F.regexp_replace(line, '"(GET|POST) /', f'"$1 /{LONG}/')


def q_report_batches_text(spark, sf_dir):
    """The batch listing of the report, written as text folders and read back."""
    store = ResultStore(spark, scratch_dir(spark, "listing-store"))
    run_job(spark, [fixture_log_dir(spark, sf_dir)], "fixed", SMALL_BATCH, "1", store=store,
            run_id="listed")
    report = run_report(store, "listed")
    path = write_report(report, scratch_dir(spark, "report"))
    return typed_tsv(spark, f"{path}/batches", report["batches"].schema)


def q_read_many_paths(spark, sf_dir):
    """24 folders, each with dt= sub-folders, as one ordered list."""
    events = event_log_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))
    root = scratch_dir(spark, "sites")
    (events.select("line", (F.col("event_id") % 24).alias("site"), (F.col("event_id") % 3).alias("dt"))
     .write.partitionBy("site", "dt").text(root))
    lines = read_log_lines(spark, [f"{root}/site={k}" for k in range(24)])
    return parse_lines(lines).groupBy("src_ordinal").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col("is_malformed")).alias("malformed_lines"))


def _long_path_store(spark, sf_dir):
    store = ResultStore(spark, scratch_dir(spark, "long-store"))
    logs = _event_files(spark, sf_dir, "long", _long_path_lines)
    for run in ("long_a", "long_b"):
        run_job(spark, [logs], "monthly", queries="2", store=store, run_id=run)
    return store


def q_compare_q2_long_paths(spark, sf_dir):
    return compare_runs(_long_path_store(spark, sf_dir), "long_a", "long_b", "q2")


def q_report_q2_long_paths(spark, sf_dir):
    return report_q2(_long_path_store(spark, sf_dir), "long_a")


def q_jdbc_paths_cut(spark, sf_dir):
    logs = parse_lines(read_log_lines(spark, [_event_files(spark, sf_dir, "long", _long_path_lines)]))
    return jdbc_frame(q2_top_resources(valid_rows(logs)))


def q_rerun_replaces_all(spark, sf_dir):
    """A second, narrower run of the same id leaves nothing of the first."""
    store, paths = ResultStore(spark, scratch_dir(spark, "rerun-store")), [fixture_log_dir(spark, sf_dir)]
    run_job(spark, paths, "fixed", FIXED_BATCH, store=store, run_id="again")
    run_job(spark, paths, "fixed", 2 * FIXED_BATCH, "1", store=store, run_id="again")
    return reduce(DataFrame.unionByName, [
        store.results(q, "again").agg(F.lit(q).alias("query"), F.count(F.lit(1)).alias("stored_rows"),
                                      F.max("batch_id").alias("last_batch"))
        for q in ("q1", "q2", "q3")])


def q_compare_all_pairs_one_failed(spark, sf_dir):
    """The run id of the sql variant is taken by another pipeline: that variant fails,
    the other two are compared."""
    store, paths = ResultStore(spark, scratch_dir(spark, "failed-store")), [fixture_log_dir(spark, sf_dir)]
    run_job(spark, paths, "monthly", queries="1", store=store, pipeline_name="other",
            run_id="part_sql")
    runs = run_all(spark, paths, store, strategy="monthly", queries="1,3", run_prefix="part")
    assert list(runs.failed) == ["sql"]
    return compare_all_pairs(store, [r.run_id for r in runs])


def _uneven_runs(spark, sf_dir):
    """Run A without status 302; run B without 404 and every tenth event."""
    store = ResultStore(spark, scratch_dir(spark, "uneven-store"))
    a = _event_files(spark, sf_dir, "uneven-a", keep="event_type <> 'signup'")
    b = _event_files(spark, sf_dir, "uneven-b", keep="event_id % 10 <> 3 AND "
                                                     "NOT (event_type = 'error' AND event_id % 2 = 0)")
    for run, logs in (("a", a), ("b", b)):
        run_job(spark, [logs], "monthly", queries="1", store=store, run_id=run)
    return store


def q_compare_diffs(spark, sf_dir):
    return compare_runs(_uneven_runs(spark, sf_dir), "a", "b", "q1")


def q_compare_first_diffs(spark, sf_dir):
    return diff_examples(q_compare_diffs(spark, sf_dir), "q1")


def _blank_errors(spark, sf_dir):
    return _logs(spark, sf_dir).withColumn("resource_path", F.when(
        F.col("status_code") >= 400, F.lit("")).otherwise(F.col("resource_path")))


def q_query_output_roundtrip_q1(spark, sf_dir):
    path = write_tsv_output(q1_daily_traffic(_logs(spark, sf_dir)), scratch_dir(spark, "q1-out"))
    return read_query_output(spark, path, "q1")


def q_query_output_roundtrip_q2(spark, sf_dir):
    path = write_tsv_output(q2_top_resources(_blank_errors(spark, sf_dir)), scratch_dir(spark, "q2-out"))
    return read_query_output(spark, path, "q2")


def _huge(logs):
    """Bytes so large that the groups above half the largest one's rows pass a long."""
    largest = logs.groupBy("log_date", "status_code").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    size = (2 ** 63 - 1) // max(largest // 2, 1)
    return logs.withColumn("bytes_transferred", F.lit(size) - F.col("bytes_transferred"))


def q_q1_huge_bytes(spark, sf_dir):
    """Byte totals around and beyond a long, in all three formulations."""
    logs = _huge(_logs(spark, sf_dir))
    logs.createOrReplaceTempView("huge_logs")
    return reduce(DataFrame.unionByName, [
        frame.withColumn("total_bytes", F.col("total_bytes").cast("string"))
        .withColumn("variant", F.lit(name)) for name, frame in (
            ("dataframe", q1_daily_traffic(logs)), ("sql", sql_query(spark, "q1", "huge_logs")),
            ("two_stage", q1_two_stage(logs)))])


def q_gzip_latin1_hosts(spark, sf_dir):
    """Gzipped ISO-8859-1 files with hosts outside ASCII."""
    lines = event_log_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))
    path = scratch_dir(spark, "latin1")
    (lines.select(F.replace("line", F.lit("host"), F.lit("hôßt")).alias("line")).repartition(4)
     .write.option("encoding", "ISO-8859-1").option("compression", "gzip").option("sep", "\x01")
     .option("quote", "").option("escape", "").csv(path))
    return valid_rows(parse_lines(read_log_lines(spark, [path]))).groupBy("host").agg(
        F.count(F.lit(1)).alias("request_count"))


def q_missing_paths_skipped(spark, sf_dir):
    logs, gone = fixture_log_dir(spark, sf_dir), scratch_dir(spark, "never-written")
    return read_log_lines(spark, [gone, logs, gone + "/x.log"]).groupBy("src_ordinal").agg(
        F.count(F.lit(1)).alias("total_lines"))


def q_staged_short_rows(spark, sf_dir):
    """Staged rows of fewer than nine fields are left out on reading."""
    logs = _logs(spark, sf_dir)
    fields = [F.col(c).cast("string") for c in LOG_COLUMNS]
    row = F.when(F.col("status_code") == 500, F.concat_ws("\t", *fields[:8])).otherwise(
        F.concat_ws("\t", *fields))
    path = scratch_dir(spark, "short-rows")
    logs.select(row.alias("value")).write.text(path)
    return read_staged_tsv(spark, path)


def q_staged_tabs(spark, sf_dir):
    """A tab inside a staged field becomes a blank."""
    logs = _logs(spark, sf_dir).withColumn("host", F.concat(F.lit("a\t"), F.col("host")))
    return read_staged_tsv(spark, stage_tsv(logs, scratch_dir(spark, "tabs")))


def q_stage_parquet_replaced(spark, sf_dir):
    path, logs = scratch_dir(spark, "replaced"), _logs(spark, sf_dir)
    stage_parquet(logs, path)
    return spark.read.parquet(stage_parquet(logs.filter("status_code = 200"), path))


def q_batch_strategy_names(spark, sf_dir):
    """Aliases, an unknown name (fixed) and a batch size that is not a number (default)."""
    staged, size = _staged(spark, sf_dir), _batch_size("many")
    return reduce(DataFrame.unionByName, [
        run_stats(batch_stats(staged, name, size), name, size) for name in ("MONTH", "Week", "bogus")])


def q_q2_ties(spark, sf_dir):
    """Every path once: the 20 first by path."""
    once = _logs(spark, sf_dir).groupBy("resource_path").agg(
        F.min("host").alias("host"), F.max("bytes_transferred").alias("bytes_transferred"))
    return q2_top_resources(once)


def q_stream_q1_daily_traffic(spark, sf_dir):
    result = stream_ingest(spark, fixture_log_dir(spark, sf_dir),
                           scratch_dir(spark, "stream"))
    return q1_daily_traffic(result.valid())


def _stream_batches(strategy):
    """The batches of the whole log, ingested file by file."""
    def run(spark, sf_dir):
        logs = set_arrival_order(spark, _event_files(spark, sf_dir, "arriving"))
        return stream_ingest(spark, logs, scratch_dir(spark, "stream"), batch_size=FIXED_BATCH).batches(strategy)
    return run


def _daily_states(spark, sf_dir, keys, where=None):
    """Host sets by finer keys, stored, with the dictionary that numbers the hosts."""
    path = scratch_dir(spark, "state-logs")
    _logs(spark, sf_dir).select("host", "log_date", "log_hour", "status_code").write.parquet(path)
    logs = spark.read.parquet(path)
    hosts = HostDictionary(spark).extend(logs)
    states = scratch_dir(spark, "states")
    distinct_state(logs, keys, hosts, where).write.parquet(states)
    return spark.read.parquet(states), hosts


def q_distinct_hosts_monthly_merged(spark, sf_dir):
    """Daily host sets merged into months."""
    states, _ = _daily_states(spark, sf_dir, ["log_date"])
    monthly = merge_states(states.withColumn("log_month", F.date_format("log_date", "yyyy-MM")), ["log_month"])
    return state_counts(monthly, ["log_month"])


def q_distinct_error_hosts_daily_merged(spark, sf_dir):
    """Hourly sets of hosts with errors merged into days."""
    states, _ = _daily_states(spark, sf_dir, ["log_date", "log_hour"], is_error())
    return state_counts(merge_states(states, ["log_date"]), ["log_date"], "distinct_error_hosts")


def q_host_sets_daily(spark, sf_dir):
    """The hosts of each day, one row per member."""
    states, hosts = _daily_states(spark, sf_dir, ["log_date"])
    return state_members(states, ["log_date"], hosts)


def _incremental(query, sources):
    """Sources applied one after another: (name, rule of its events)."""
    def run(spark, sf_dir):
        kept = IncrementalResults(spark, scratch_dir(spark, "incremental-store"))
        for k, (name, keep) in enumerate(sources):
            kept.apply(name, _event_files(spark, sf_dir, f"source-{k}", keep=keep))
        return kept.results(query)
    return run


_HALVES = (("even", "event_id % 2 = 0"), ("odd", "event_id % 2 = 1"))
#: the first source comes twice: at first it has other lines and other days
_REPLACED = (("even", "event_id % 3 = 1 OR event_type = 'error'"), *_HALVES[::-1])


def q_failed_run_keeps_earlier(spark, sf_dir):
    """A second run of an id that stops between its tables: readers see the first."""
    store = ResultStore(spark, scratch_dir(spark, "atomic-store"))
    run_job(spark, [fixture_log_dir(spark, sf_dir)], "monthly", queries="1", store=store, run_id="kept")

    class Stops(ResultStore):
        def write_run_metadata(self, row):
            raise RuntimeError("the run stops here")
    try:
        run_job(spark, [fixture_log_dir(spark, sf_dir, "orders")], "monthly", queries="1",
                store=Stops(spark, store.root, store.database), run_id="kept")
    except RuntimeError:
        pass
    return store.results("q1", "kept").select("log_date", "status_code", "request_count", "total_bytes")


def q_compare_all_pairs_uneven(spark, sf_dir):
    return compare_all_pairs(_uneven_runs(spark, sf_dir), ["a", "b"], ["q1"])


def q_external_table_second_session(spark, sf_dir):
    """The table of one session, read in another one of the same catalog."""
    path = stage_tsv(_logs(spark, sf_dir), scratch_dir(spark, "stage-shared"))
    register_external_table(spark, path, "access_logs_shared")
    return spark.newSession().table("access_logs_shared")


def q_query_output_ranked_q2(spark, sf_dir):
    """Q2 with its ranks, written as several part files and read back."""
    top = q2_top_resources(_logs(spark, sf_dir))
    path = write_tsv_output(top, scratch_dir(spark, "q2-ranked"),
                            [F.col("request_count").desc(), F.col("resource_path").asc()])
    return read_ranked_output(spark, path, "q2")


def q_read_path_twice(spark, sf_dir):
    """A folder, one of its files and the folder again, as one scan."""
    folder = fixture_log_dir(spark, sf_dir)
    file = sorted(spark.read.text(folder).inputFiles())[0]
    return parse_lines(read_log_lines(spark, [folder, file, folder])).filter("src_ordinal <> 1").groupBy(
        "src_ordinal").agg(F.count(F.lit(1)).alias("total_lines"),
                           F.count_if(F.col("is_malformed")).alias("malformed_lines"))


def _training_part():
    """(queries, pipeline) modules of the training-data part; None for what is not installed.

    The pipeline is looked up beside this file, and only where the operators it is made of are.
    """
    try:
        found = importlib.util.find_spec("logweave.llm.queries")
    except ModuleNotFoundError:            # logweave.llm is not there
        found = None
    if not found:
        return None, None
    own = os.path.exists(os.path.join(_HERE, "corpus_pipeline.py"))
    return (importlib.import_module("logweave.llm.queries"),
            importlib.import_module("corpus_pipeline") if own else None)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily traffic (Q1) of the sf0.001 events logs."""
    return q1_daily_traffic(_logs(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Registered queries; the inventory ids each one exercises.

    parse_*, request_parts, bytes_normalised: S1-S3, P1-P8 | q1_* / q2_* / q3_*:
    Q1-Q3, A1-A5, O1-O2, F1-F2, P11-P14 (dataframe, sql, two_stage, orders input) |
    batch_*: B1-B6, B8 | run_stats: B9 | stage_*: K1, S5, S7 | external_table_scan:
    S6 | query_output_roundtrip: K3, S8 | result_append_by_run: K4, K7, F3, P10 |
    run_metadata_sink / batch_metadata_sink: K5, K6 | report_*: R1, O4, O5, P15 |
    compare_*: R2-R7, A7 | selected_queries_job: A8 | report_batches_text: R1, O5 |
    read_many_paths, gzip_latin1_hosts, missing_paths_skipped: S1-S4 | staged_*: S7, P9 |
    jdbc_paths_cut: P10 | report_q2_long_paths: P15 | batch_strategy_names: B6, B7 |
    stage_parquet_replaced: K2 | rerun_replaces_all: K4, K5 | compare_*_failed, _diffs: R5,
    R6, R8 | q1_huge_bytes: A2 | q2_ties: O2 | query_output_roundtrip_*: K3 | stream_q1_daily_traffic:
    the batch-by-batch load as Structured Streaming | stream_batches_*: B1, B5, B8 over
    micro-batches | distinct_*_merged, host_sets_daily: A3, A5, A6 | incremental_*: A7 |
    failed_run_keeps_earlier: K4-K6 | compare_all_pairs_uneven: R5, R6 |
    external_table_second_session: S6 | query_output_ranked_q2: S8 | read_path_twice: S1.
    """
    llm, pipeline = _training_part()
    return {
        **(llm.llm_queries() if llm else {}),
        **({"pipeline": pipeline.run} if pipeline else {}),
        "parse_valid_rows": q_parse_valid_rows,
        "parse_malformed_rows": q_parse_malformed_rows,
        "parse_status_counts": q_parse_status_counts,
        "request_parts": q_request_parts,
        "bytes_normalised": q_bytes_normalised,
        "q1_daily_traffic": lambda s, d: q1_daily_traffic(_logs(s, d)),
        "q1_sql": _sql_variant("q1"),
        "q1_two_stage": lambda s, d: q1_two_stage(_logs(s, d)),
        "q1_daily_traffic_orders": lambda s, d: q1_daily_traffic(_logs(s, d, "orders")),
        "q2_top_resources": lambda s, d: q2_top_resources(_logs(s, d)),
        "q2_sql": _sql_variant("q2"),
        "q2_two_stage": lambda s, d: q2_two_stage(_logs(s, d)),
        "q3_hourly_errors": lambda s, d: q3_hourly_errors(_logs(s, d)),
        "q3_sql": _sql_variant("q3"),
        "q3_two_stage": lambda s, d: q3_two_stage(_logs(s, d)),
        "q3_hourly_errors_orders": lambda s, d: q3_hourly_errors(_logs(s, d, "orders")),
        "batch_fixed": _batch("fixed"),
        "batch_monthly": _batch("monthly"),
        "batch_weekly": _batch("weekly"),
        "batch_weekly_orders": _batch("weekly", "orders"),
        "batch_malformed_key": q_batch_malformed_key,
        "run_stats": q_run_stats,
        "stage_tsv_roundtrip": q_stage_tsv_roundtrip,
        "stage_parquet_roundtrip": q_stage_parquet_roundtrip,
        "external_table_scan": q_external_table_scan,
        "query_output_roundtrip": q_query_output_roundtrip,
        "result_append_by_run": q_result_append_by_run,
        "run_metadata_sink": q_run_metadata_sink,
        "batch_metadata_sink": q_batch_metadata_sink,
        "report_batches": _report(report_batches),
        "report_q1": _report(report_q1),
        "report_q2": _report(report_q2),
        "report_q3": _report(report_q3),
        "compare_q1": _compare("q1"),
        "compare_q2": _compare("q2"),
        "compare_q3": _compare("q3"),
        "compare_q1_mixed_inputs": q_compare_q1_mixed_inputs,
        "compare_summary": q_compare_summary,
        "compare_all_pairs": q_compare_all_pairs,
        "selected_queries_job": q_selected_queries_job,
        "report_batches_text": q_report_batches_text,
        "read_many_paths": q_read_many_paths,
        "compare_q2_long_paths": q_compare_q2_long_paths,
        "report_q2_long_paths": q_report_q2_long_paths,
        "jdbc_paths_cut": q_jdbc_paths_cut,
        "rerun_replaces_all": q_rerun_replaces_all,
        "compare_all_pairs_one_failed": q_compare_all_pairs_one_failed,
        "compare_diffs": q_compare_diffs,
        "compare_first_diffs": q_compare_first_diffs,
        "query_output_roundtrip_q1": q_query_output_roundtrip_q1,
        "query_output_roundtrip_q2": q_query_output_roundtrip_q2,
        "q1_huge_bytes": q_q1_huge_bytes,
        "gzip_latin1_hosts": q_gzip_latin1_hosts,
        "missing_paths_skipped": q_missing_paths_skipped,
        "staged_short_rows": q_staged_short_rows,
        "staged_tabs": q_staged_tabs,
        "stage_parquet_replaced": q_stage_parquet_replaced,
        "batch_strategy_names": q_batch_strategy_names,
        "q2_ties": q_q2_ties,
        "stream_q1_daily_traffic": q_stream_q1_daily_traffic,
        "stream_batches_fixed": _stream_batches("fixed"),
        "stream_batches_monthly": _stream_batches("monthly"),
        "stream_batches_weekly": _stream_batches("weekly"),
        "q2_top_resources_orders": lambda s, d: q2_top_resources(_logs(s, d, "orders")),
        "distinct_hosts_monthly_merged": q_distinct_hosts_monthly_merged,
        "distinct_error_hosts_daily_merged": q_distinct_error_hosts_daily_merged,
        "host_sets_daily": q_host_sets_daily,
        "incremental_append_q1": _incremental("q1", _HALVES),
        "incremental_append_q3": _incremental("q3", _HALVES),
        "incremental_replace_q3": _incremental("q3", _REPLACED),
        "failed_run_keeps_earlier": q_failed_run_keeps_earlier,
        "compare_all_pairs_uneven": q_compare_all_pairs_uneven,
        "external_table_second_session": q_external_table_second_session,
        "query_output_ranked_q2": q_query_output_ranked_q2,
        "read_path_twice": q_read_path_twice,
    }


# -- DuckDB oracles -------------------------------------------------------------
# ev/lg: the events log-line rule computed column by column (no line parsing).
_EVENTS = """
WITH ev AS (
  SELECT event_id AS eid, user_id, event_type, value, props,
         ts + to_days(CAST(event_id % 60 AS INTEGER)) AS t
  FROM events
), lg AS (
  SELECT eid, t,
    'host' || CAST(user_id AS VARCHAR) || '.example.com' AS host,
    strftime(t, '%d/%b/%Y:%H:%M:%S') || ' ' ||
      (CASE eid % 3 WHEN 0 THEN '-0400' WHEN 1 THEN '+0000' ELSE '+0530' END) AS ts,
    CAST(t AS DATE) AS log_date,
    CAST(hour(t) AS INTEGER) AS log_hour,
    CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS http_method,
    '/' || event_type || '/' || regexp_extract(props, '"k": *(-?[0-9]+)', 1) || '.html' AS resource_path,
    'HTTP/1.0' AS protocol_version,
    CAST(CASE WHEN event_type = 'error' THEN (CASE WHEN eid % 2 = 0 THEN 404 ELSE 500 END)
              WHEN event_type = 'signup' THEN 302
              WHEN event_type = 'view' AND eid % 5 = 0 THEN 304
              ELSE 200 END AS INTEGER) AS status_code,
    CASE WHEN eid % 11 = 0 THEN '-'
         ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS bytes_text,
    CASE WHEN eid % 11 = 0 THEN CAST(0 AS BIGINT)
         ELSE CAST(floor(value * 100) AS BIGINT) END AS bytes_transferred,
    eid % 89 = 0 AS no_date,
    (eid % 89 = 0 OR eid % 97 = 0) AS is_malformed
  FROM ev
), logs AS (
  SELECT host, ts, log_date, log_hour, http_method, resource_path, protocol_version,
         status_code, bytes_transferred
  FROM lg WHERE NOT is_malformed
)
"""

_ORDERS = """
WITH od AS (
  SELECT o_orderkey AS eid, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS t
  FROM orders
), lg AS (
  SELECT eid, t,
    'cust' || CAST(o_custkey AS VARCHAR) || '.example.org' AS host,
    strftime(t, '%d/%b/%Y:%H:%M:%S') || ' -0700' AS ts,
    CAST(t AS DATE) AS log_date,
    CAST(hour(t) AS INTEGER) AS log_hour,
    'GET' AS http_method,
    '/priority/' || split_part(o_orderpriority, ' ', 1) AS resource_path,
    CASE WHEN contains(o_orderpriority, ' ') THEN split_part(o_orderpriority, ' ', 2)
         ELSE 'HTTP/1.1' END AS protocol_version,
    CAST(CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 304 ELSE 503 END AS INTEGER)
      AS status_code,
    CAST(floor(o_totalprice) AS BIGINT) AS bytes_transferred,
    eid % 101 = 0 AS no_date,
    eid % 101 = 0 AS is_malformed
  FROM od
), logs AS (
  SELECT host, ts, log_date, log_hour, http_method, resource_path, protocol_version,
         status_code, bytes_transferred
  FROM lg WHERE NOT is_malformed
)
"""

_ERR = "status_code BETWEEN 400 AND 599"

_Q1 = """SELECT log_date, status_code, count(*) AS request_count,
       CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
FROM logs GROUP BY log_date, status_code"""

_Q2 = """SELECT resource_path, count(*) AS request_count,
       CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
       count(DISTINCT host) AS distinct_host_count
FROM logs GROUP BY resource_path
ORDER BY request_count DESC, resource_path ASC LIMIT 20"""

_Q3 = f"""SELECT log_date, log_hour,
       CAST(count_if({_ERR}) AS BIGINT) AS error_request_count,
       count(*) AS total_request_count,
       CASE WHEN count(*) > 0 THEN CAST(count_if({_ERR}) AS DOUBLE) / count(*)
            ELSE 0.0 END AS error_rate,
       count(DISTINCT CASE WHEN {_ERR} THEN host END) AS distinct_error_hosts
FROM logs GROUP BY log_date, log_hour"""

_MALFORMED_LINE = """CASE WHEN no_date THEN 'garbage ' || CAST(eid AS VARCHAR)
     ELSE host || ' - - [' || ts || '] "' || http_method || ' ' || resource_path ||
          ' HTTP/1.0 ' || CAST(status_code AS VARCHAR) || ' ' || bytes_text END"""


def _batches(key_sql: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY min(eid)) AS BIGINT) AS batch_sequence,
       batch_key, count(*) AS total_records,
       count(*) - CAST(count_if(is_malformed) AS BIGINT) AS valid_records,
       CAST(count_if(is_malformed) AS BIGINT) AS malformed_records
FROM (SELECT eid, is_malformed, {key_sql} AS batch_key FROM lg) k
GROUP BY batch_key"""


_MONTH_KEY = "CASE WHEN no_date THEN '__malformed__' ELSE strftime(t, '%Y-%m') END"
_WEEK_KEY = "CASE WHEN no_date THEN '__malformed__' ELSE strftime(t, '%G-W%V') END"

def _fixed_sql(size: int) -> str:
    return f"""SELECT CAST(b AS BIGINT) AS batch_sequence, 'batch_' || CAST(b AS VARCHAR) AS batch_key,
       count(*) AS total_records,
       count(*) - CAST(count_if(is_malformed) AS BIGINT) AS valid_records,
       CAST(count_if(is_malformed) AS BIGINT) AS malformed_records
FROM (SELECT (row_number() OVER (ORDER BY eid) - 1) // {size} + 1 AS b, is_malformed
      FROM lg) f
GROUP BY b"""


_FIXED = _fixed_sql(FIXED_BATCH)


def _run_stats_row(strategy: str, batch_size: int, batches_sql: str) -> str:
    return f"""SELECT '{strategy}' AS batch_strategy, CAST({batch_size} AS BIGINT) AS batch_size,
       CAST(sum(total_records) AS BIGINT) AS total_records,
       CAST(sum(malformed_records) AS BIGINT) AS malformed_records,
       count(*) AS num_batches,
       CAST(sum(total_records) AS DOUBLE) / count(*) AS avg_batch_size
FROM ({batches_sql}) s"""


_NUM_FIXED_BATCHES = f"(SELECT CAST(ceil(count(*) / {FIXED_BATCH}.0) AS BIGINT) FROM lg)"


def _compare_sql(base: str, keys: list[str], values: list[str]) -> str:
    cols = ", ".join(keys + [f"{v} AS a_{v}" for v in values] + [f"{v} AS b_{v}" for v in values])
    return f"SELECT {cols}, 'match' AS outcome FROM ({base}) q"


_Q3_COMPARE = f"""SELECT log_date, log_hour, error_request_count, total_request_count,
       CASE WHEN total_request_count > 0
            THEN CAST(error_request_count AS DOUBLE) / total_request_count ELSE 0.0 END
         AS error_rate, distinct_error_hosts FROM ({_Q3}) z"""


def _runs():
    return [f"{RUN_PREFIX}_{v}" for v in ("dataframe", "sql", "two_stage")]


def _all_pairs_sql() -> str:
    runs = _runs()
    rows = []
    for i, a in enumerate(runs):
        for b in runs[i + 1:]:
            for q, base in (("q1", _Q1), ("q2", _Q2), ("q3", _Q3)):
                rows.append(f"""SELECT '{a}' AS run_a, '{b}' AS run_b, '{q}' AS query,
       count(*) AS rows_a, count(*) AS rows_b, CAST(0 AS BIGINT) AS mismatched_rows,
       true AS matched, 'match' AS verdict FROM ({base}) x""")
    return _EVENTS + "\nUNION ALL\n".join(rows)


def _mixed_inputs_sql() -> str:
    """Both CTE chains in one statement (orders' CTEs renamed)."""
    orders = (_ORDERS.replace("WITH od AS", ", od AS").replace("lg AS", "lg_o AS")
              .replace("FROM lg WHERE", "FROM lg_o WHERE").replace("logs AS", "logs_o AS"))
    q1_o = _Q1.replace("FROM logs", "FROM logs_o")
    return _EVENTS + orders + f"""
SELECT log_date, status_code, request_count AS a_request_count, total_bytes AS a_total_bytes,
       request_count AS b_request_count, total_bytes AS b_total_bytes, 'match' AS outcome
FROM ({_Q1}) e
UNION ALL
SELECT log_date, status_code, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
       request_count, total_bytes, 'only_b'
FROM ({q1_o}) o"""


_UNEVEN = f"""SELECT coalesce(a.log_date, b.log_date) AS log_date,
       coalesce(a.status_code, b.status_code) AS status_code,
       a.request_count AS a_request_count, a.total_bytes AS a_total_bytes,
       b.request_count AS b_request_count, b.total_bytes AS b_total_bytes,
       CASE WHEN b.log_date IS NULL THEN 'only_a' WHEN a.log_date IS NULL THEN 'only_b'
            WHEN a.request_count = b.request_count AND a.total_bytes = b.total_bytes THEN 'match'
            ELSE 'mismatch' END AS outcome
FROM ({_Q1.replace("FROM logs", "FROM lg WHERE NOT is_malformed AND status_code <> 302")}) a
FULL JOIN ({_Q1.replace("FROM logs", "FROM lg WHERE NOT is_malformed AND status_code <> 404 AND eid % 10 <> 3")}) b
  ON a.log_date = b.log_date AND a.status_code = b.status_code"""

_LONG_Q2 = _Q2.replace("SELECT resource_path", f"SELECT '/{LONG}' || resource_path AS resource_path", 1)


def _one_failed_sql() -> str:
    return "\nUNION ALL\n".join(f"""SELECT 'part_dataframe' AS run_a, 'part_two_stage' AS run_b,
       '{q}' AS query, {rows} AS rows_a, {rows} AS rows_b, CAST(0 AS BIGINT) AS mismatched_rows,
       {matched} AS matched, '{verdict}' AS verdict""" for q, rows, matched, verdict in (
        ("q1", f"(SELECT count(*) FROM ({_Q1}) x)", "true", "match"),
        ("q2", "CAST(0 AS BIGINT)", "CAST(NULL AS BOOLEAN)", "not_run"),
        ("q3", f"(SELECT count(*) FROM ({_Q3}) x)", "true", "match")))


def _huge_sql() -> str:
    size = """(SELECT CAST(9223372036854775807 AS HUGEINT) // greatest(max(n) // 2, 1)
       FROM (SELECT count(*) AS n FROM logs GROUP BY log_date, status_code) g)"""
    total = f"count(*) * any_value({size}) - sum(CAST(bytes_transferred AS HUGEINT))"
    return "\nUNION ALL\n".join(f"""SELECT log_date, status_code, count(*) AS request_count,
       CASE WHEN {total} <= 9223372036854775807 THEN CAST({total} AS VARCHAR) END AS total_bytes,
       '{variant}' AS variant
FROM logs GROUP BY log_date, status_code"""
                                for variant in ("dataframe", "sql", "two_stage"))


def oracle_sql() -> dict[str, str]:
    e, o = _EVENTS, _ORDERS
    run_a = _runs()[0]
    meta_rows = []
    for name in _runs():
        variant = name[len(RUN_PREFIX) + 1:]
        meta_rows.append(f"""SELECT '{name}' AS run_id, '{variant}' AS pipeline_name,
       'fixed' AS batch_strategy, CAST({FIXED_BATCH} AS BIGINT) AS batch_size,
       count(*) AS total_records, CAST(count_if(is_malformed) AS BIGINT) AS malformed_records,
       CAST(ceil(count(*) / {FIXED_BATCH}.0) AS BIGINT) AS num_batches,
       CAST(count(*) / ceil(count(*) / {FIXED_BATCH}.0) AS DECIMAL(20,2)) AS avg_batch_size
FROM lg""")
    llm, pipeline = _training_part()
    return {
        **(llm.llm_oracles() if llm else {}),
        **({"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {}),
        "parse_valid_rows": e + "SELECT * FROM logs",
        "parse_malformed_rows": e + f"SELECT {_MALFORMED_LINE} AS line FROM lg WHERE is_malformed",
        "parse_status_counts": e + """SELECT count(*) AS total_lines,
       CAST(count_if(NOT is_malformed) AS BIGINT) AS valid_lines,
       CAST(count_if(is_malformed) AS BIGINT) AS malformed_lines FROM lg""",
        "request_parts": o + """SELECT http_method, resource_path, protocol_version,
       count(*) AS request_count FROM logs GROUP BY ALL""",
        "bytes_normalised": e + """SELECT status_code, count(*) AS request_count,
       CAST(count_if(bytes_transferred = 0) AS BIGINT) AS zero_byte_requests,
       CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
       min(bytes_transferred) AS min_bytes, max(bytes_transferred) AS max_bytes
FROM logs GROUP BY status_code""",
        "q1_daily_traffic": e + _Q1,
        "q1_sql": e + _Q1,
        "q1_two_stage": e + _Q1,
        "q1_daily_traffic_orders": o + _Q1,
        "q2_top_resources": e + _Q2,
        "q2_sql": e + _Q2,
        "q2_two_stage": e + _Q2,
        "q3_hourly_errors": e + _Q3,
        "q3_sql": e + _Q3,
        "q3_two_stage": e + _Q3,
        "q3_hourly_errors_orders": o + _Q3,
        "batch_fixed": e + _FIXED,
        "batch_monthly": e + _batches(_MONTH_KEY),
        "batch_weekly": e + _batches(_WEEK_KEY),
        "batch_weekly_orders": o + _batches(_WEEK_KEY),
        "batch_malformed_key": e + f"""SELECT {_MALFORMED_LINE} AS line,
       {_MONTH_KEY} AS month_key, {_WEEK_KEY} AS week_key FROM lg WHERE is_malformed""",
        "run_stats": e + "\nUNION ALL\n".join([
            _run_stats_row("fixed", FIXED_BATCH, _FIXED),
            _run_stats_row("monthly", 10000, _batches(_MONTH_KEY)),
            _run_stats_row("weekly", 10000, _batches(_WEEK_KEY))]),
        "stage_tsv_roundtrip": e + "SELECT * FROM logs",
        "stage_parquet_roundtrip": e + "SELECT * FROM logs",
        "external_table_scan": e + "SELECT * FROM logs",
        "query_output_roundtrip": e + _Q3,
        "result_append_by_run": e + f"""SELECT 'dataframe' AS pipeline_name, 'run_a' AS run_id,
       {_NUM_FIXED_BATCHES} AS batch_id, q.* FROM ({_Q1}) q""",
        "run_metadata_sink": e + "\nUNION ALL\n".join(meta_rows),
        "batch_metadata_sink": e + f"""SELECT 'dataframe' AS pipeline_name, '{run_a}' AS run_id,
       batch_sequence, batch_key, 'fixed' AS batch_strategy, total_records, valid_records,
       malformed_records FROM ({_FIXED}) f""",
        "report_batches": e + f"""SELECT batch_sequence, batch_key, 'fixed' AS batch_strategy,
       total_records, valid_records, malformed_records FROM ({_FIXED}) f""",
        "report_q1": e + f"SELECT * FROM ({_Q1}) q ORDER BY log_date, status_code LIMIT 20",
        "report_q2": e + f"""SELECT CASE WHEN length(resource_path) > 47
            THEN substr(resource_path, 1, 44) || '...' ELSE resource_path END AS resource_path,
       request_count, total_bytes, distinct_host_count FROM ({_Q2}) q""",
        "report_q3": e + f"""SELECT log_date, log_hour, error_request_count, total_request_count,
       round(error_rate, 4) AS error_rate, distinct_error_hosts
FROM ({_Q3}) q ORDER BY log_date, log_hour LIMIT 20""",
        "compare_q1": e + _compare_sql(_Q1, ["log_date", "status_code"],
                                       ["request_count", "total_bytes"]),
        "compare_q2": e + _compare_sql(_Q2, ["resource_path"],
                                       ["request_count", "total_bytes", "distinct_host_count"]),
        "compare_q3": e + _compare_sql(_Q3_COMPARE, ["log_date", "log_hour"],
                                       ["error_request_count", "total_request_count",
                                        "error_rate", "distinct_error_hosts"]),
        "compare_q1_mixed_inputs": _mixed_inputs_sql(),
        "compare_summary": e + "\nUNION ALL\n".join(
            f"""SELECT '{_runs()[0]}' AS run_a, '{_runs()[2]}' AS run_b, '{q}' AS query,
       count(*) AS rows_a, count(*) AS rows_b, CAST(0 AS BIGINT) AS mismatched_rows,
       true AS matched, 'match' AS verdict,
       (SELECT count(*) FROM lg) AS a_total_records,
       (SELECT CAST(count_if(is_malformed) AS BIGINT) FROM lg) AS a_malformed_records,
       (SELECT count(*) FROM lg) AS b_total_records,
       (SELECT CAST(count_if(is_malformed) AS BIGINT) FROM lg) AS b_malformed_records
FROM ({base}) x""" for q, base in (("q1", _Q1), ("q2", _Q2), ("q3", _Q3))),
        "compare_all_pairs": _all_pairs_sql(),
        "selected_queries_job": e + f"""SELECT 'q1' AS query, count(*) AS result_rows FROM ({_Q1}) a
UNION ALL SELECT 'q3' AS query, count(*) AS result_rows FROM ({_Q3}) b""",
        "report_batches_text": e + f"""SELECT batch_sequence, batch_key, 'fixed' AS batch_strategy,
       total_records, valid_records, malformed_records FROM ({_fixed_sql(SMALL_BATCH)}) f""",
        "read_many_paths": e + """SELECT CAST(eid % 24 AS INTEGER) AS src_ordinal, count(*) AS total_lines,
       CAST(count_if(is_malformed) AS BIGINT) AS malformed_lines FROM lg GROUP BY 1""",
        "compare_q2_long_paths": e + _compare_sql(_LONG_Q2, ["resource_path"], [
            "request_count", "total_bytes", "distinct_host_count"]),
        "report_q2_long_paths": e + f"""SELECT substr(resource_path, 1, 44) || '...' AS resource_path,
       request_count, total_bytes, distinct_host_count FROM ({_LONG_Q2}) q""",
        "jdbc_paths_cut": e + f"""SELECT substr(resource_path, 1, 512) AS resource_path,
       request_count, total_bytes, distinct_host_count FROM ({_LONG_Q2}) q""",
        "rerun_replaces_all": e + f"""SELECT 'q1' AS query, count(*) AS stored_rows,
       (SELECT CAST(ceil(count(*) / {2 * FIXED_BATCH}.0) AS BIGINT) FROM lg) AS last_batch
FROM ({_Q1}) a
UNION ALL SELECT 'q2', CAST(0 AS BIGINT), CAST(NULL AS BIGINT)
UNION ALL SELECT 'q3', CAST(0 AS BIGINT), CAST(NULL AS BIGINT)""",
        "compare_all_pairs_one_failed": e + _one_failed_sql(),
        "compare_diffs": e + _UNEVEN,
        "compare_first_diffs": e + f"""SELECT * FROM ({_UNEVEN}) u WHERE outcome <> 'match'
ORDER BY log_date, status_code LIMIT 5""",
        "query_output_roundtrip_q1": e + _Q1,
        "query_output_roundtrip_q2": e + _Q2.replace(
            "FROM logs", "FROM (SELECT * REPLACE (CASE WHEN status_code >= 400 THEN '' "
                         "ELSE resource_path END AS resource_path) FROM logs) l"),
        "q1_huge_bytes": e + _huge_sql(),
        "gzip_latin1_hosts": e + """SELECT replace(host, 'host', 'hôßt') AS host,
       count(*) AS request_count FROM logs GROUP BY 1""",
        "missing_paths_skipped": e + """SELECT CAST(1 AS INTEGER) AS src_ordinal,
       count(*) AS total_lines FROM lg""",
        "staged_short_rows": e + "SELECT * FROM logs WHERE status_code <> 500",
        "staged_tabs": e + "SELECT * REPLACE ('a ' || host AS host) FROM logs",
        "stage_parquet_replaced": e + "SELECT * FROM logs WHERE status_code = 200",
        "batch_strategy_names": e + "\nUNION ALL\n".join([
            _run_stats_row("monthly", 10000, _batches(_MONTH_KEY)),
            _run_stats_row("weekly", 10000, _batches(_WEEK_KEY)),
            _run_stats_row("fixed", 10000, _fixed_sql(10000))]),
        "q2_ties": e + """SELECT resource_path, CAST(1 AS BIGINT) AS request_count,
       max(bytes_transferred) AS total_bytes, CAST(1 AS BIGINT) AS distinct_host_count
FROM logs GROUP BY resource_path ORDER BY resource_path LIMIT 20""",
        "stream_q1_daily_traffic": e + _Q1,
        "stream_batches_fixed": e + _FIXED,
        "stream_batches_monthly": e + _batches(_MONTH_KEY),
        "stream_batches_weekly": e + _batches(_WEEK_KEY),
        "q2_top_resources_orders": o + _Q2,
        "distinct_hosts_monthly_merged": e + """SELECT strftime(log_date, '%Y-%m') AS log_month,
       count(DISTINCT host) AS distinct_hosts FROM logs GROUP BY 1""",
        "distinct_error_hosts_daily_merged": e + f"""SELECT log_date, count(DISTINCT host) AS distinct_error_hosts
FROM logs WHERE {_ERR} GROUP BY log_date""",
        "host_sets_daily": e + "SELECT DISTINCT log_date, host FROM logs",
        "incremental_append_q1": e + _Q1,
        "incremental_append_q3": e + _Q3,
        "incremental_replace_q3": e + _Q3,
        "failed_run_keeps_earlier": e + _Q1,
        "compare_all_pairs_uneven": e + f"""SELECT 'a' AS run_a, 'b' AS run_b, 'q1' AS query,
       CAST(count_if(outcome <> 'only_b') AS BIGINT) AS rows_a, CAST(count_if(outcome <> 'only_a') AS BIGINT) AS rows_b,
       CAST(count_if(outcome <> 'match') AS BIGINT) AS mismatched_rows, count_if(outcome <> 'match') = 0 AS matched,
       CASE WHEN count_if(outcome <> 'match') = 0 THEN 'match' ELSE 'mismatch' END AS verdict FROM ({_UNEVEN}) u""",
        "external_table_second_session": e + "SELECT * FROM logs",
        "query_output_ranked_q2": e + f"""SELECT *, row_number() OVER (
         ORDER BY request_count DESC, resource_path) AS rank FROM ({_Q2}) q""",
        "read_path_twice": e + """SELECT CAST(o AS INTEGER) AS src_ordinal, count(*) AS total_lines,
       CAST(count_if(is_malformed) AS BIGINT) AS malformed_lines
FROM lg, (VALUES (0), (2)) v(o) GROUP BY o""",
    }
