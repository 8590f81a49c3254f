"""Plan properties the scale design relies on (regression guards)."""

import pytest
from pyspark.sql import functions as F

from logweave.operators.batching import batch_stats
from logweave.operators.queries import DATAFRAME_QUERIES
from logweave.plans.job import parse_for_staging
from logweave.schemas import LOG_COLUMNS
from logweave.session import scratch_dir
from logweave.sinks.store import stage_parquet
from logweave.sources.fixtures import fixture_log_dir
from logweave.sources.text import read_log_lines
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    df.collect()                       # adaptive plans are final after execution
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark):
    lines = read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])
    path = stage_parquet(parse_for_staging(lines), scratch_dir(spark, "plan-tests"))
    return spark.read.parquet(path)


def test_staging_is_one_map_only_pass(spark):
    lines = read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])
    plan = parse_for_staging(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_queries_push_the_filter_and_read_only_their_columns(staged):
    valid = staged.filter(~F.col("is_malformed")).select(*LOG_COLUMNS)
    expect = {"q1": {"log_date", "status_code", "bytes_transferred"},
              "q2": {"host", "resource_path", "bytes_transferred"},
              "q3": {"host", "log_date", "log_hour", "status_code"}}
    for q, fn in DATAFRAME_QUERIES.items():
        plan = _plan(fn(valid))
        scans = {ln.strip(" +-:*()0123456789") for ln in plan.split("== Initial Plan ==")[0].splitlines()
                 if "FileScan parquet" in ln}
        assert len(scans) == (2 if q == "q2" else 1), scans          # Q2: paths first, then the top paths' hosts
        names = set()
        for scan in scans:
            assert "PushedFilters: [IsNotNull(is_malformed)" in scan, scan
            read = scan.split("ReadSchema: struct<")[1].split(">")[0]
            columns = {part.split(":")[0] for part in read.split(",")}
            assert columns <= expect[q] | {"is_malformed"} and len(columns) <= 5, (q, columns)
            assert q != "q2" or not {"host", "bytes_transferred"} <= columns
            names |= columns
        assert names == expect[q] | {"is_malformed"}, (q, names)
        assert "SortAggregate" not in plan
    assert "TakeOrderedAndProject" in _plan(DATAFRAME_QUERIES["q2"](valid))


def test_line_index_broadcasts_and_aggregates_by_hash(staged):
    fixed = _plan(batch_stats(staged, "fixed", 100))
    assert "BroadcastHashJoin" in fixed and "SortAggregate" not in fixed
    monthly = _plan(batch_stats(staged, "monthly"))
    # the line-level aggregate is a hash aggregate; only the small per-(key, split)
    # frame may use a sort aggregate for min(struct)
    line_level = monthly.split("Exchange hashpartitioning")[-1]
    assert "HashAggregate" in line_level and "SortAggregate" not in line_level
