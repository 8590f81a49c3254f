"""Benchmark: the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS].

Input: access-log text files derived from the ``events`` table (written once,
untimed).  Timed, each on its own:

* ``parse_stage``    read the text logs, parse every line, write the staged
                     Parquet table (the one full pass over raw text);
  (this and the batching / query steps report the best of two fresh runs)
* ``batch_fixed`` / ``batch_monthly`` / ``batch_weekly``  per-batch accounting
                     from the staged table (fixed uses the global line index);
* ``q1`` / ``q2`` / ``q3``  each query over the staged valid rows;
* ``queries_from_text``  all three queries straight from the text (no staging);
* ``job_end_to_end`` one full run: parse, stage, batch, query, write results
                     and metadata to the result store;
* ``compare_all_pairs``  three variant runs compared pairwise.

A warm-up on the smallest scale factor runs first (JVM and code-generation
warm-up; not counted).  Prints one JSON line; its ``profile`` field holds, per
step, the jobs, stages, tasks, task seconds and shuffle megabytes read from
Spark's event log (written to a scratch folder of this local run).
"""

from __future__ import annotations

import json
import os
import platform
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from logweave.functions.parse import parse_lines, valid_rows  # noqa: E402
from logweave.operators.batching import batch_stats  # noqa: E402
from logweave.operators.compare import compare_all_pairs  # noqa: E402
from logweave.operators.queries import DATAFRAME_QUERIES  # noqa: E402
from logweave.plans.job import parse_for_staging, run_all, run_job  # noqa: E402
from logweave.schemas import LOG_COLUMNS  # noqa: E402
from logweave.session import local_session, scratch_dir  # noqa: E402
from logweave.sinks.store import ResultStore, stage_parquet  # noqa: E402
from logweave.sources.fixtures import fixture_log_dir  # noqa: E402
from logweave.sources.text import read_log_lines, rebalance_lines  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
LOG_FILES = max(4, CPUS)      # at least one split per core
WARMUP_DIR = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")


def _sf_number(sf_dir: str):
    text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(text)
    except ValueError:
        return text


_SPARK = None


def _timed(fn, step: str | None = None):
    """Run ``fn`` under a job description (for the event-log profile)."""
    if step and _SPARK is not None:
        _SPARK.sparkContext.setJobDescription(step)
    t = time.perf_counter()
    fn()
    elapsed = time.perf_counter() - t
    if step and _SPARK is not None:
        _SPARK.sparkContext.setJobDescription(None)
    return elapsed


def _best(fn, step: str, reps: int = 2) -> float:
    """Best of ``reps`` fresh runs (each re-planned); the event-log profile is
    taken from the last one."""
    return min(_timed(fn, step if i == reps - 1 else None) for i in range(reps))


def _profile(event_dir: str) -> dict:
    """Jobs, stages, tasks, task seconds and shuffle MB per bench step."""
    files = [os.path.join(root, f) for root, _, names in os.walk(event_dir)
             for f in names if not f.startswith(".") and not f.startswith("appstatus")]
    if not files:
        return {}
    stage_step, out = {}, {}
    with open(max(files, key=os.path.getmtime), encoding="utf-8") as fh:
        for raw in fh:
            event = json.loads(raw)
            kind = event.get("Event")
            if kind == "SparkListenerJobStart":
                step = (event.get("Properties") or {}).get("spark.job.description")
                if not step or not step.startswith("bench:"):
                    continue
                step = step[len("bench:"):]
                rec = out.setdefault(step, {"jobs": 0, "stages": 0, "tasks": 0,
                                            "task_sec": 0.0, "shuffle_write_mb": 0.0})
                rec["jobs"] += 1
                for sid in event.get("Stage IDs", []):
                    stage_step[sid] = step
            elif kind == "SparkListenerStageCompleted":
                sid = event["Stage Info"]["Stage ID"]
                if sid in stage_step:
                    out[stage_step[sid]]["stages"] += 1
            elif kind == "SparkListenerTaskEnd":
                step = stage_step.get(event.get("Stage ID"))
                if step is None:
                    continue
                rec = out[step]
                rec["tasks"] += 1
                metrics = event.get("Task Metrics") or {}
                rec["task_sec"] += metrics.get("Executor Run Time", 0) / 1000.0
                shuffle = metrics.get("Shuffle Write Metrics") or {}
                rec["shuffle_write_mb"] += shuffle.get("Shuffle Bytes Written", 0) / 2**20
    for rec in out.values():
        rec["task_sec"] = round(rec["task_sec"], 3)
        rec["shuffle_write_mb"] = round(rec["shuffle_write_mb"], 3)
    return out


def _drain(df):
    """Run a frame to completion without pulling rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def run_suite(spark, sf_dir, tag=""):
    times = {}
    logs_dir = fixture_log_dir(spark, sf_dir, num_files=LOG_FILES)
    staged_paths = []

    def parse_stage():
        staged_paths.append(scratch_dir(spark, "bench-staged"))
        stage_parquet(parse_for_staging(rebalance_lines(read_log_lines(spark, [logs_dir]))),
                      staged_paths[-1])
    times["parse_stage"] = _best(parse_stage, f"{tag}parse_stage")
    staged = spark.read.parquet(staged_paths[-1])
    valid = staged.filter(~F.col("is_malformed")).select(*LOG_COLUMNS)

    times["batch_fixed"] = _best(lambda: _drain(batch_stats(staged, "fixed", 10000, persisted=True)),
                                 f"{tag}batch_fixed")
    times["batch_monthly"] = _best(lambda: _drain(batch_stats(staged, "monthly")),
                                   f"{tag}batch_monthly")
    times["batch_weekly"] = _best(lambda: _drain(batch_stats(staged, "weekly")),
                                  f"{tag}batch_weekly")
    for q, fn in DATAFRAME_QUERIES.items():
        times[q] = _best(lambda fn=fn: fn(valid).collect(), f"{tag}{q}")

    def from_text():
        logs = valid_rows(parse_lines(read_log_lines(spark, [logs_dir])))
        for fn in DATAFRAME_QUERIES.values():
            fn(logs).collect()
    times["queries_from_text"] = _timed(from_text, f"{tag}queries_from_text")

    store = ResultStore(spark, scratch_dir(spark, "bench-store"))
    times["job_end_to_end"] = _timed(lambda: run_job(
        spark, [logs_dir], "fixed", 10000, store=store, pipeline_name="dataframe"),
        f"{tag}job_end_to_end")

    runs = []
    times["run_all"] = _timed(lambda: runs.extend(
        run_all(spark, [logs_dir], store, strategy="monthly")), f"{tag}run_all")
    times["compare_all_pairs"] = _timed(lambda: compare_all_pairs(
        store, [r.run_id for r in runs]).collect(), f"{tag}compare_all_pairs")
    return times


def main():
    global _SPARK
    # Spark's event log, in a scratch folder of this local run, gives the per-step
    # stage / task profile (the bench always runs on local[N]).
    event_dir = tempfile.mkdtemp(prefix="logweave-bench-events-")
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS",
                          f"--conf spark.eventLog.enabled=true "
                          f"--conf spark.eventLog.dir=file://{event_dir} "
                          f"--conf spark.eventLog.compress=false "
                          f"--conf spark.eventLog.rolling.enabled=false pyspark-shell")
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS * 2), app_name="logweave-bench")
    _SPARK = spark
    t = time.perf_counter()
    run_suite(spark, WARMUP_DIR)
    warmup = time.perf_counter() - t
    fixture_log_dir(spark, SF_DIR, num_files=LOG_FILES)       # input text files, untimed
    times = run_suite(spark, SF_DIR, tag="bench:")
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    headline = ["parse_stage", "batch_fixed", "batch_monthly", "batch_weekly", "q1", "q2", "q3"]
    out = {
        "metric": "parse_stage_batches_and_queries_total",
        "value": round(sum(times[k] for k in headline), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": _sf_number(SF_DIR),
        "log_lines": rows,
        "lines_per_sec_parse_stage": round(rows / times["parse_stage"], 1),
        "warmup_sec": round(warmup, 3),
        "cpus": CPUS,
        "machine": f"{platform.machine()} {os.cpu_count()} cpus, {platform.system()}",
    }
    spark.stop()
    out["profile"] = _profile(event_dir)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
