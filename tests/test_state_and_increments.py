"""Mergeable distinct states, incremental results, streamed batches, atomic runs, digests, paths, ranks."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from logweave.operators.batching import batch_stats
from logweave.operators.compare import compare_all_pairs, compare_runs
from logweave.operators.distinct_state import (HostDictionary, distinct_state, merge_states, state_counts,
                                               state_members)
from logweave.operators.queries import DATAFRAME_QUERIES, TWO_STAGE_QUERIES, q1_daily_traffic, q3_hourly_errors
from logweave.functions.parse import parse_lines, valid_rows
from logweave.plans.incremental import IncrementalResults, source_id
from logweave.plans.job import parse_for_staging, run_job
from logweave.plans.sql import sql_query
from logweave.sinks.markers import place, place_once, read_marker
from logweave.sinks.store import ResultStore, stage_parquet, stage_tsv, write_tsv_output
from logweave.sources.fixtures import fixture_log_dir, set_arrival_order
from logweave.sources.staged import (drop_external_table, read_query_output, read_ranked_output,
                                     register_external_table)
from logweave.sources.text import read_log_lines
from logweave.streaming.ingest import _process, stream_ingest
from tests.conftest import SF_SMALL, write_lines


def line(host, day=1, hour=0, status=200, path="/a", size=10):
    return f'{host} - - [{day:02d}/Jul/1995:{hour:02d}:00:00 -0400] "GET {path} HTTP/1.0" {status} {size}'


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# -- Q2: hosts of the top paths only ---------------------------------------------

def test_hosts_are_shuffled_for_the_top_paths_only(spark, tmp_path):
    lines = [line(f"h{k % 7}", path=f"/p{k % 60}") for k in range(900)]
    logs = valid_rows(parse_lines(read_log_lines(spark, [write_lines(tmp_path / "a.log", lines)])))
    logs = spark.read.parquet(stage_parquet(logs, str(tmp_path / "staged")))
    logs.createOrReplaceTempView("late_hosts")
    for frame in (DATAFRAME_QUERIES["q2"](logs), TWO_STAGE_QUERIES["q2"](logs), sql_query(spark, "q2", "late_hosts")):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        by_host = [p for p in plan.splitlines() if "Exchange hashpartitioning" in p and "host" in p]
        assert by_host, plan
        for exchange in by_host:                     # the join with the 20 paths lies below it
            below = plan[plan.index(exchange):]
            assert "BroadcastHashJoin" in below, plan
        assert rows_of(frame) == rows_of(DATAFRAME_QUERIES["q2"](logs)) and frame.count() == 20


def test_late_hosts_of_null_paths_and_hosts(spark):
    logs = spark.createDataFrame([(None, "a", 1), (None, None, 2), ("/x", None, 3)],
                                 "resource_path string, host string, bytes_transferred long").withColumns(
        {"log_date": F.lit(None).cast("date"), "log_hour": F.lit(0)})
    expected = [("/x", 1, 3, 0), (None, 2, 3, 1)]
    for variant in (DATAFRAME_QUERIES, TWO_STAGE_QUERIES):
        assert rows_of(variant["q2"](logs)) == sorted(expected, key=repr)


# -- distinct states ---------------------------------------------------------------

def test_states_merge_to_direct_counts(spark):
    rows = [(d, h, f"host{(d * 31 + h * 7 + k * k) % 97}") for d in range(6) for h in range(4) for k in range(30)]
    rows += [(0, 0, None), (7, 0, None)]
    logs = spark.createDataFrame(rows, "day long, hour long, host string").repartition(5)
    hosts = HostDictionary(spark).extend(logs.filter("day < 3")).extend(logs).extend(logs)
    numbers = sorted(r.host_id for r in hosts.frame().collect())
    assert numbers == list(range(1, 1 + logs.select("host").filter("host IS NOT NULL").distinct().count()))
    fine = distinct_state(logs, ["day", "hour"], hosts)
    assert rows_of(state_counts(fine, ["day", "hour"])) == rows_of(
        logs.filter("host IS NOT NULL").groupBy("day", "hour").agg(F.count_distinct("host")))
    daily = merge_states(fine, ["day"])
    assert rows_of(state_counts(daily, ["day"])) == rows_of(
        logs.filter("host IS NOT NULL").groupBy("day").agg(F.count_distinct("host")))
    assert rows_of(state_members(daily, ["day"], hosts)) == rows_of(
        logs.filter("host IS NOT NULL").select("day", "host").distinct())
    some = distinct_state(logs, ["day"], hosts, where=F.col("hour") == 2)
    assert rows_of(state_counts(some, ["day"])) == rows_of(
        logs.filter("hour = 2 AND host IS NOT NULL").groupBy("day").agg(F.count_distinct("host")))


def test_states_over_many_buckets(spark):
    """Numbers beyond one bitmap: rows of 4 KB, never an array by key."""
    logs = spark.range(70000).select(F.lit("k").alias("key"), F.concat(F.lit("h"), "id").alias("host"))
    hosts = HostDictionary(spark).extend(logs)
    state = distinct_state(logs, ["key"], hosts)
    assert state.count() == 3 and {r[0] for r in state.select(F.octet_length("bitmap")).collect()} == {4096}
    assert state_counts(state, ["key"]).first().distinct_hosts == 70000
    assert state_members(state, ["key"], hosts).distinct().count() == 70000


def test_state_of_no_rows(spark):
    logs = spark.createDataFrame([], "key string, host string")
    hosts = HostDictionary(spark).extend(logs)
    assert state_counts(distinct_state(logs, ["key"], hosts), ["key"]).count() == 0


# -- incremental results ------------------------------------------------------------

def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_append_replace_and_remove_equal_a_recompute(spark, tmp_path):
    def logs(name, lines):
        return write_lines(tmp_path / name, lines)
    a = [line(f"h{k % 9}", 1 + k % 3, k % 5, (200, 404, 500)[k % 3]) for k in range(80)]
    b = [line(f"h{k % 14}", 3 + k % 3, k % 5, (200, 404)[k % 2]) for k in range(90)] + ["no log line"]
    a2 = [line(f"g{k % 5}", 2, k % 5, (200, 404)[k % 2]) for k in range(30)]
    kept = IncrementalResults(spark, str(tmp_path / "store"))
    paths = {"a": logs("a.log", a), "b": logs("b.log", b), "a2": logs("a2.log", a2)}

    def check(names):
        whole = valid_rows(parse_lines(read_log_lines(spark, [paths[n] for n in names])))
        assert rows_of(kept.results("q1")) == rows_of(q1_daily_traffic(whole))
        assert rows_of(kept.results("q3")) == rows_of(q3_hourly_errors(whole))

    assert kept.results("q1").count() == 0
    day = dt.date(1995, 7, 1)
    assert kept.apply("first", paths["a"]) == [day, day.replace(day=2), day.replace(day=3)]
    check(["a"])
    before = _files(tmp_path / "store" / "results_q1")
    assert kept.apply("second", paths["b"]) == [day.replace(day=d) for d in (3, 4, 5)]
    check(["a", "b"])
    after = _files(tmp_path / "store" / "results_q1")
    untouched = {f: t for f, t in before.items() if "1995-07-03" not in f}
    assert untouched and all(after[f] == t for f, t in untouched.items())
    assert kept.apply("first", paths["a2"]) == [day.replace(day=d) for d in (1, 2, 3)]     # day 1 has no lines now
    check(["b", "a2"])
    kept.remove("second")
    check(["a2"])
    assert IncrementalResults(spark, str(tmp_path / "store")).results("q1").count() == kept.results("q1").count()


def test_a_failed_apply_is_taken_up(spark, tmp_path, monkeypatch):
    kept = IncrementalResults(spark, str(tmp_path / "store"))
    first = write_lines(tmp_path / "a.log", [line("x", 1), line("y", 2)])
    second = write_lines(tmp_path / "b.log", [line("z", 5)])
    monkeypatch.setattr(IncrementalResults, "_compute", lambda self, dates: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.apply("first", first)
    monkeypatch.undo()
    assert kept.results("q1").count() == 0
    kept.apply("second", second)                       # computes the dates of the failed call, too
    assert kept.results("q1").count() == 3
    assert source_id("first") != source_id("second")


# -- streamed batches ------------------------------------------------------------------

@pytest.mark.parametrize("per_batch", [1, 3])
def test_streamed_batches_are_those_of_the_batch_form(spark, tmp_path, per_batch):
    folder = set_arrival_order(spark, _copy(fixture_log_dir(spark, SF_SMALL), tmp_path / "logs"))
    staged = parse_for_staging(read_log_lines(spark, [folder]))
    result = stream_ingest(spark, folder, str(tmp_path / "out"), per_batch, batch_size=70)
    for strategy in ("fixed", "month", "weekly"):
        assert rows_of(result.batches(strategy)) == rows_of(batch_stats(staged, strategy, 70)), strategy
    assert result.micro_batches().count() == -(-4 // per_batch)


def test_a_replayed_epoch_changes_nothing(spark, tmp_path):
    folder = set_arrival_order(spark, _copy(fixture_log_dir(spark, SF_SMALL), tmp_path / "logs"))
    result = stream_ingest(spark, folder, str(tmp_path / "out"), 2, batch_size=70)
    before = {s: rows_of(result.batches(s)) for s in ("fixed", "monthly")}
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    again = spark.read.text([os.path.join(folder, f) for f in files[:2]]).select("value", "_metadata")
    _process(result.parsed_path, result.batches_path, 70)(again, 0)          # epoch 0 once more, after epoch 1
    assert {s: rows_of(result.batches(s)) for s in ("fixed", "monthly")} == before


def test_a_later_file_continues_the_numbers(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    write_lines(folder / "b.log", [line("h", 1)] * 5 + ["no date"])
    out = str(tmp_path / "out")
    stream_ingest(spark, str(folder), out, batch_size=4)
    write_lines(folder / "a.log", [line("h", 9)] * 3)                          # arrives later, whatever its name
    result = stream_ingest(spark, str(folder), out, batch_size=4)
    assert rows_of(result.batches("fixed")) == [(1, "batch_1", 4, 4, 0), (2, "batch_2", 4, 3, 1), (3, "batch_3", 1, 1, 0)]
    assert [r.batch_key for r in result.batches("monthly").orderBy("batch_sequence").collect()] == [
        "1995-07", "__malformed__"]


def _copy(folder, to):
    folder = folder.removeprefix("file:")
    to.mkdir()
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            (to / name).write_bytes(open(os.path.join(folder, name), "rb").read())
    return str(to)


# -- runs as a whole ------------------------------------------------------------------

@pytest.mark.parametrize("stops_at", ["write_batch_metadata", "write_results", "write_run_metadata", "commit"])
def test_a_run_that_fails_leaves_the_earlier_one(spark, tmp_path, stops_at):
    store = ResultStore(spark, str(tmp_path / "store"))
    small = write_lines(tmp_path / "a.log", [line("x"), line("y", 2)])
    large = write_lines(tmp_path / "b.log", [line("x", d) for d in range(1, 20)])

    def state(s):
        return [rows_of(s.results(q, "r").drop("execution_time")) for q in ("q1", "q2", "q3")] + [
            rows_of(s.batch_metadata("r").drop("started_at", "completed_at")),
            rows_of(s.run_metadata("r").select("run_id", "total_records"))]

    class Stops(ResultStore):
        pass

    def stop(self, *args, **kwargs):
        raise RuntimeError("stopped")
    setattr(Stops, stops_at, stop)
    stopping = Stops(spark, store.root, store.database)
    with pytest.raises(RuntimeError):
        run_job(spark, [large], store=stopping, pipeline_name="p", run_id="r")
    assert state(store) == [[], [], [], [], []] and store.table("run_metadata").count() == 0
    run_job(spark, [small], store=store, pipeline_name="p", run_id="r")
    first = state(store)
    assert first[4] == [("r", 2)]
    with pytest.raises(RuntimeError):
        run_job(spark, [large], store=stopping, pipeline_name="p", run_id="r")
    assert state(store) == first
    store.remove_uncommitted()
    assert state(store) == first
    run_job(spark, [large], store=store, pipeline_name="p", run_id="r")
    assert state(store)[4] == [("r", 19)] and store.remove_uncommitted() == 0


def test_one_of_two_claims_wins(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "store"))
    for k in range(10):
        refused, start = [], threading.Barrier(4)

        def claim(pipeline):
            start.wait()
            try:
                store.claim(pipeline, f"run{k}")
            except ValueError:
                refused.append(pipeline)
        threads = [threading.Thread(target=claim, args=(f"p{n}",)) for n in range(4)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        winner = read_marker(spark, f"{store.root}/claims/run{k}")
        assert len(refused) == 3 and winner not in refused


def test_markers(spark, tmp_path):
    path = str(tmp_path / "deep" / "marker")
    assert read_marker(spark, path) is None
    assert place_once(spark, path, "one") and not place_once(spark, path, "two")
    assert read_marker(spark, path) == "one"
    place(spark, path, "three")
    assert read_marker(spark, path) == "three" and os.listdir(tmp_path / "deep") == ["marker"]


# -- digests of many runs ---------------------------------------------------------------

def _many_runs(spark, store, runs, change):
    """Q1 rows of many runs in one write: ``change(run)`` lists (key, request_count)."""
    store.ensure_tables()
    rows = [(1, None, dt.date(2024, 1, 1) + dt.timedelta(days=day), 200, n, 5 * n, "p", run, "t")
            for run in runs for day, n in change(run)]
    schema = ("batch_id long, execution_time timestamp, log_date date, status_code int, request_count long, "
              "total_bytes long, pipeline_name string, run_id string, attempt string")
    part = ["pipeline_name", "run_id", "attempt"]
    spark.createDataFrame(rows, schema).repartition("run_id").write.partitionBy(*part).parquet(
        f"{store.root}/query1_results", mode="append")
    meta = [(r, "p", "fixed", 1, 1, 0, 1, "q1", "t") for r in runs]
    spark.createDataFrame(meta, "run_id string, pipeline_name string, batch_strategy string, batch_size long, "
                                "total_records long, malformed_records long, num_batches long, queries string, "
                                "attempt string").write.partitionBy(*part).parquet(
        f"{store.root}/run_metadata", mode="append")
    for name in ("query1_results", "run_metadata"):
        spark.sql(f"ALTER TABLE {store.qualified(name)} RECOVER PARTITIONS")
    for run in runs:
        place(spark, f"{store.root}/commits/{run}.json",
              f'{{"run_id": "{run}", "pipeline_name": "p", "attempt": "t"}}')


def test_two_hundred_runs_are_compared_by_digests(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "store"))
    runs = [f"run{k:03d}" for k in range(200)]
    base = [(day, 10 + day) for day in range(30)]

    def rows(run):
        k = int(run[3:])
        if k == 17:
            return [(d, n + (d == 4)) for d, n in base]            # one value
        if k == 90:
            return base[:-2]                                       # two keys fewer
        if k == 91:
            return [(d + 100, n) for d, n in base]                 # no key in common
        return [] if k == 199 else base
    _many_runs(spark, store, runs, rows)
    found = {(r.run_a, r.run_b): (r.rows_a, r.rows_b, r.mismatched_rows, r.verdict)
             for r in compare_all_pairs(store, runs, ["q1"]).collect()}
    assert len(found) == 200 * 199 // 2

    def expected(a, b):
        x, y = dict(rows(a)), dict(rows(b))
        wrong = sum(x.get(k) != y.get(k) for k in x.keys() | y.keys())
        return len(x), len(y), wrong, "mismatch" if wrong else "match"
    assert found == {(a, b): expected(a, b) for i, a in enumerate(runs) for b in runs[i + 1:]}
    one = compare_runs(store, "run000", "run090", "q1")
    assert one.filter("outcome <> 'match'").count() == 2


# -- external table, paths, ranks ---------------------------------------------------------

@pytest.mark.parametrize("fmt", ["tsv", "parquet"])
def test_external_table_outlives_the_session_and_leaves_files(spark, tmp_path, fmt):
    lines = [line(f"h{k}", path="/a" if k else "/") for k in range(5)]
    logs = valid_rows(parse_lines(read_log_lines(spark, [write_lines(tmp_path / "a.log", lines)])))
    path = str(tmp_path / "staged dir's")
    stage_tsv(logs, path) if fmt == "tsv" else stage_parquet(logs, path)
    if fmt == "tsv":
        (tmp_path / "staged dir's" / "part-short").write_text("too\tfew\tfields\n\n")
    register_external_table(spark, path, "ext_table", fmt)
    other = spark.newSession()
    assert rows_of(other.table("ext_table")) == rows_of(logs)
    assert other.table("ext_table").dtypes == logs.dtypes
    register_external_table(other, path, "ext_table", fmt)                   # dropped and made again
    assert spark.table("ext_table").count() == 5
    files = os.listdir(path)
    drop_external_table(spark, "ext_table")
    assert not other.catalog.tableExists("ext_table") and os.listdir(path) == files
    drop_external_table(spark, "ext_table")                                  # nothing there: fine


def test_many_paths_are_one_scan_in_order(spark, tmp_path):
    paths = [write_lines(tmp_path / f"log {k % 7} [{k}]+%{k}.log", [f"line {k}.{n}" for n in range(2)])
             for k in range(300)]
    asked = [paths[5], *reversed(paths), str(tmp_path / "gone"), paths[5]]
    lines = read_log_lines(spark, asked)
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("Relation [value") == 1
    got = [r.line for r in lines.orderBy("src_ordinal", "src_file", "src_block", "src_seq").collect()]
    order = [5, *range(299, -1, -1), 5]
    assert got == [f"line {k}.{n}" for k in order for n in range(2)]
    with pytest.raises(FileNotFoundError):
        read_log_lines(spark, asked, missing="fail")
    inside = tmp_path / "a folder [1]+%2" / "dt=1"
    inside.mkdir(parents=True)
    write_lines(inside / "in %41 [x].log", ["inner"])
    write_lines(inside / "_hidden", ["hidden"])
    both = read_log_lines(spark, [str(inside.parent), paths[0], str(inside.parent)])
    assert sorted((r.src_ordinal, r.line) for r in both.collect()) == [
        (0, "inner"), (1, "line 0.0"), (1, "line 0.1"), (2, "inner")]
    folder = read_log_lines(spark, [str(tmp_path / "*.log")])
    assert folder.count() == 600 and {r[0] for r in folder.select("src_ordinal").distinct().collect()} == {0}


def test_ranks_survive_part_files(spark, tmp_path):
    rows = [(f"/p{k}", 50 - k // 2, k, 1) for k in range(40)]
    frame = spark.createDataFrame(rows, "resource_path string, request_count long, total_bytes long, "
                                        "distinct_host_count long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_tsv_output(frame, str(tmp_path / "out"), [F.col("request_count").desc(), "resource_path"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 1
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in read_query_output(spark, path, "q2").collect()] == expected
    assert [tuple(r) for r in read_ranked_output(spark, path, "q2").collect()] == [
        (*r, k + 1) for k, r in enumerate(expected)]
    plain = write_tsv_output(frame, str(tmp_path / "plain"))
    assert rows_of(read_query_output(spark, plain, "q2")) == rows_of(frame)
