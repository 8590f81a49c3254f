"""Result store (K4-K7, F3), report (R1) and run comparison."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from logweave.operators.compare import (compare_all_pairs, compare_runs,
                                        compare_summary, diff_examples)
from logweave.plans.job import run_all, run_job
from logweave.plans.report import format_report, run_report
from logweave.sinks.store import ResultStore
from logweave.sources.fixtures import fixture_log_dir
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    store = ResultStore(spark, str(tmp_path_factory.mktemp("store")))
    jobs = run_all(spark, [fixture_log_dir(spark, SF_SMALL)], store, strategy="monthly",
                   run_prefix="t")
    return store, [j.run_id for j in jobs]


def test_all_variants_match_pairwise(runs):
    store, ids = runs
    pairs = compare_all_pairs(store, ids).collect()
    assert len(pairs) == 9 and all(p.matched for p in pairs)
    summary = compare_summary(store, ids[0], ids[1]).collect()
    assert all(r.matched for r in summary)
    assert summary[0].a_total_records == summary[0].b_total_records == 1000


def test_rerun_replaces_only_its_partition(spark, runs, tmp_path):
    store, ids = runs
    before = store.results("q1", ids[0]).count()
    job = run_job(spark, [fixture_log_dir(spark, SF_SMALL)], "monthly", store=store,
                  pipeline_name="dataframe", run_id=ids[0])
    assert store.results("q1", ids[0]).count() == before
    assert store.results("q1", ids[1]).count() == before
    assert store.run_metadata(ids[0]).count() == 1
    assert store.batch_metadata(ids[0]).count() == job.run_row["num_batches"]
    # a new store object over the same root (a new session) sees the same rows
    again = ResultStore(spark, store.root, database="lw_reopen_" + uuid.uuid4().hex[:6])
    assert again.results("q1", ids[0]).count() == before


def _plant(spark, store, source_run, new_run, query, change):
    """Copy a run's rows of ``query`` with a change applied, as another run."""
    rows = store.results(query, source_run).drop("pipeline_name", "run_id",
                                                 "batch_id", "execution_time")
    rows = spark.createDataFrame(rows.collect(), rows.schema)   # small test frame
    store.write_results(query, change(rows), "planted", new_run, 1, dt.datetime(2024, 1, 1))
    store.write_run_metadata(dict(store.run_metadata(source_run).first().asDict(),
                                  run_id=new_run, pipeline_name="planted"))


def test_planted_differences_are_found(spark, runs):
    store, ids = runs
    base = ids[0]
    # Q1: one key's byte total changed
    first = store.results("q1", base).orderBy("log_date", "status_code").first()
    bump = (F.col("log_date") == first.log_date) & (F.col("status_code") == first.status_code)
    _plant(spark, store, base, "planted_q1", "q1",
           lambda df: df.withColumn("total_bytes", F.when(bump, F.col("total_bytes") + 1)
                                    .otherwise(F.col("total_bytes"))))
    cmp = compare_runs(store, base, "planted_q1", "q1")
    outcomes = {r.outcome: r["count"] for r in cmp.groupBy("outcome").count().collect()}
    assert outcomes.get("mismatch") == 1
    assert diff_examples(cmp, "q1").count() == 1
    # Q3: one hour dropped -> row count differs
    _plant(spark, store, base, "planted_q3", "q3",
           lambda df: df.filter(~((F.col("log_date") == first.log_date) & (F.col("log_hour") == 0))))
    q3 = compare_runs(store, base, "planted_q3", "q3")
    assert q3.filter("outcome = 'only_a'").count() >= 1
    summary = {r.query: r for r in compare_summary(store, base, "planted_q3", ["q3"]).collect()}
    assert not summary["q3"].matched and summary["q3"].rows_a > summary["q3"].rows_b
    # Q3: a distinct-host change, which the reference checker would not see
    _plant(spark, store, base, "planted_hosts", "q3",
           lambda df: df.withColumn("distinct_error_hosts", F.col("distinct_error_hosts") + 1))
    assert compare_runs(store, base, "planted_hosts", "q3") \
        .filter("outcome = 'mismatch'").count() > 0
    # all pairs: the planted run fails against every real run; unknown runs are left out
    pairs = compare_all_pairs(store, [base, ids[1], "planted_q1", "never_ran"], ["q1"]).collect()
    verdict = {(p.run_a, p.run_b): p.matched for p in pairs}
    assert verdict == {(base, ids[1]): True, (base, "planted_q1"): False,
                       (ids[1], "planted_q1"): False}


def test_report_frames(runs):
    store, ids = runs
    report = run_report(store, ids[0])
    assert report["metadata"].count() == 1
    assert report["q2"].count() == 20
    seqs = [r.batch_sequence for r in report["batches"].collect()]
    assert seqs == list(range(1, len(seqs) + 1))
    text = format_report(report)
    assert "== q3 ==" in text and "error_rate" in text


def test_command_line_run_report_compare(spark, tmp_path, capsys):
    from logweave.__main__ import main
    folder = fixture_log_dir(spark, SF_SMALL)
    store = str(tmp_path / "cli-store")
    tsv = str(tmp_path / "tsv-out")
    assert main(["run", "--store", store, "--strategy", "month", "--queries", "2",
                 "--run-id", "cli_a", "--tsv-output", tsv, folder]) == 0
    from logweave.sources.staged import read_query_output
    assert read_query_output(spark, f"{tsv}/q2", "q2").count() == 20
    assert main(["run", "--store", store, "--variant", "sql", "--batch-size", "abc",
                 "--run-id", "cli_b", folder]) == 0
    out = capsys.readouterr().out
    assert "cli_a" in out and "== q2 ==" in out
    meta = {r.run_id: r for r in ResultStore(spark, store).run_metadata().collect()}
    assert meta["cli_b"].batch_size == 10000 and meta["cli_a"].batch_strategy == "monthly"
    assert main(["compare", "--store", store, "cli_a", "cli_b"]) == 0
    assert main(["report", "--store", store, "cli_a"]) == 0


def test_display_and_sink_widths(spark, tmp_path):
    from logweave.functions.display import display_path, display_rate, sink_path
    long_path = "/" + "a" * 49
    row = spark.createDataFrame([(long_path, "/short", 0.123456789)], "p string, s string, r double") \
        .select(display_path(F.col("p")).alias("p"), display_path(F.col("s")).alias("s"),
                display_rate(F.col("r")).alias("r"), sink_path(F.lit("/" + "x" * 600)).alias("k")) \
        .first()
    assert row.p == long_path[:44] + "..." and len(row.p) == 47
    assert row.s == "/short" and row.r == 0.1235 and len(row.k) == 512
    store = ResultStore(spark, str(tmp_path / "wide"))
    frame = spark.createDataFrame([("/" + "y" * 700, 1, 2, 1)],
                                  "resource_path string, request_count long, total_bytes long, "
                                  "distinct_host_count long")
    store.write_results("q2", frame, "dataframe", "wide_run", 1, dt.datetime(2024, 1, 1))
    stored = store.results("q2", "wide_run").first()
    assert len(stored.resource_path) == 701 and stored.batch_id == 1      # stored whole
    from logweave.sinks.store import jdbc_frame
    assert len(jdbc_frame(store.results("q2", "wide_run")).first().resource_path) == 512


def test_run_metadata_holds_very_large_batches(spark, tmp_path):
    from decimal import Decimal
    store = ResultStore(spark, str(tmp_path / "big-meta"))
    now = dt.datetime(2024, 1, 1)
    row = dict(run_id="huge", pipeline_name="dataframe", batch_strategy="monthly",
               batch_size=10000, total_records=10**12, malformed_records=5, num_batches=12,
               avg_batch_size=Decimal("83333333333.33"), runtime_seconds=Decimal("1.000"),
               started_at=now, completed_at=now, queries="q1")
    store.write_run_metadata(row)
    assert store.run_metadata("huge").first().avg_batch_size == Decimal("83333333333.33")


def test_command_line_run_all(spark, tmp_path, capsys):
    from logweave.__main__ import main
    folder = fixture_log_dir(spark, SF_SMALL)
    store = str(tmp_path / "cli-all")
    assert main(["run-all", "--store", store, "--strategy", "week", "--queries", "1,2",
                 folder]) == 0
    out = capsys.readouterr().out
    assert out.count("== metadata ==") == 3           # one report per variant
    assert "matched" in out and "false" not in out    # every pair matches
    meta = ResultStore(spark, store).run_metadata().collect()
    assert sorted(r.pipeline_name for r in meta) == ["dataframe", "sql", "two_stage"]


def test_command_line_reports_bad_input(tmp_path, capsys):
    from logweave.__main__ import main
    store = str(tmp_path / "cli-bad")
    assert main(["run", "--store", store, "--batch-size", "0", str(tmp_path / "x.log")]) == 2
    assert main(["run", "--store", store, str(tmp_path / "missing.log")]) == 2
    err = capsys.readouterr().err
    assert "batch_size must be positive" in err and "FileNotFoundError" in err
