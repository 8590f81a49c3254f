"""A task that fails once must not change any result (retried scan, write commit).

Runs in its own process: task retries need a ``local[N,maxFailures]`` master,
and the failure is injected by a test-only UDF on the first attempt of one
scan task while the parsed rows are staged.
"""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import json, sys, tempfile
sys.path.insert(0, ROOT)
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import StringType
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
if not spark.sparkContext.getCheckpointDir():
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logweave-resilience-"))
from logweave.operators.batching import batch_stats
from logweave.plans.job import parse_for_staging
from logweave.session import scratch_dir
from logweave.sinks.store import stage_parquet
from logweave.sources.fixtures import fixture_log_dir
from logweave.sources.text import read_log_lines

MARKER = tempfile.mkdtemp(prefix="logweave-failed-")


@F.udf(StringType())
def fails_once(line):
    ctx = TaskContext.get()
    if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        open(f"{MARKER}/failed-stage{ctx.stageId()}", "w").close()
        raise RuntimeError("injected task failure")
    return line

@F.udf("boolean")
def fails_once_flag(flag):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(f"{MARKER}/failed-batching-stage{ctx.stageId()}", "w").close()
        raise RuntimeError("injected task failure")
    return flag


folder = fixture_log_dir(spark, SF)
lines = read_log_lines(spark, [folder])
clean = stage_parquet(parse_for_staging(lines), scratch_dir(spark, "clean"))
flaky = stage_parquet(parse_for_staging(lines.withColumn("line", fails_once("line"))),
                      scratch_dir(spark, "flaky"))
a, b = spark.read.parquet(clean), spark.read.parquet(flaky)
out = {
    "rows": [a.count(), b.count()],
    "same_rows": a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0,
    "same_batches": sorted(map(tuple, batch_stats(a, "fixed", 37).collect()))
                    == sorted(map(tuple, batch_stats(b, "fixed", 37).collect())),
    "same_batches_after_failures": sorted(map(tuple, batch_stats(a, "fixed", 37).collect()))
        == sorted(map(tuple, batch_stats(
            a.withColumn("is_malformed", fails_once_flag("is_malformed")), "fixed", 37).collect())),
    "partitions": lines.rdd.getNumPartitions(),
    "failures": len(__import__("os").listdir(MARKER)),
}
print("RESULT " + json.dumps(out))
"""


def test_a_failed_task_changes_nothing():
    code = SCRIPT.replace("ROOT", repr(ROOT)).replace("SF", repr("/root/testdata/sf0.001"))
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                          timeout=600, cwd=ROOT)
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    out = json.loads(lines[-1][len("RESULT "):])
    assert out["partitions"] > 1                      # the failing task exists
    assert out["rows"][0] == out["rows"][1] == 1000
    assert out["same_rows"] and out["same_batches"] and out["same_batches_after_failures"]
    assert out["failures"] >= 2                       # the failures really happened
