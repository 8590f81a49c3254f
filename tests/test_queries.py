"""The three queries: variants agree, ordering, tie-break, zero-error hours."""

import datetime as dt

from pyspark.sql import functions as F

from logweave.functions.parse import parse_lines, valid_rows
from logweave.operators.queries import DATAFRAME_QUERIES, TWO_STAGE_QUERIES
from logweave.plans.job import run_query, select_queries
from logweave.plans.sql import sql_query
from logweave.sources.fixtures import fixture_log_dir
from logweave.sources.text import read_log_lines
from tests.conftest import SF_SMALL


def _logs(spark):
    return valid_rows(parse_lines(read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])))


def test_variants_agree(spark):
    logs = _logs(spark)
    logs.createOrReplaceTempView("access_logs_t")
    for q in ("q1", "q2", "q3"):
        a = DATAFRAME_QUERIES[q](logs).collect()
        b = TWO_STAGE_QUERIES[q](logs).collect()
        c = sql_query(spark, q, "access_logs_t").collect()
        assert a == b == c, q          # same rows in the same order


def _frame(spark, rows):
    return spark.createDataFrame(rows, "host string, ts string, log_date date, log_hour int, "
                                       "http_method string, resource_path string, "
                                       "protocol_version string, status_code int, "
                                       "bytes_transferred long")


def test_q2_ties_broken_by_path_and_limited(spark):
    d = dt.date(1995, 7, 1)
    rows = [(f"h{i % 3}", "t", d, 0, "GET", f"/p{i:02d}", "", 200, 1) for i in range(25)]
    rows += [("h9", "t", d, 0, "GET", "/hot", "", 200, 10)] * 3
    out = DATAFRAME_QUERIES["q2"](_frame(spark, rows)).collect()
    assert len(out) == 20
    assert out[0].resource_path == "/hot" and out[0].request_count == 3
    assert out[0].total_bytes == 30 and out[0].distinct_host_count == 1
    assert [r.resource_path for r in out[1:]] == [f"/p{i:02d}" for i in range(19)]


def test_q3_keeps_hours_without_errors_and_counts_error_hosts(spark):
    d = dt.date(1995, 7, 1)
    rows = [("a", "t", d, 0, "GET", "/", "", 200, 1),
            ("a", "t", d, 1, "GET", "/", "", 404, 1),
            ("a", "t", d, 1, "GET", "/", "", 500, 1),
            ("b", "t", d, 1, "GET", "/", "", 599, 1),
            ("c", "t", d, 1, "GET", "/", "", 600, 1),
            ("d", "t", d, 1, "GET", "/", "", 399, 1)]
    logs = _frame(spark, rows)
    for fn in (DATAFRAME_QUERIES["q3"], TWO_STAGE_QUERIES["q3"]):
        out = [tuple(r) for r in fn(logs).collect()]
        assert out == [(d, 0, 0, 1, 0.0, 0), (d, 1, 3, 5, 0.6, 2)]


def test_query_selection():
    assert select_queries(None) == ("q1", "q2", "q3")
    assert select_queries("a") == ("q1", "q2", "q3")
    assert select_queries("3,1") == ("q1", "q3")
    assert select_queries(["q2", "q9"]) == ("q2",)
    assert select_queries("7,x") == ("q1", "q2", "q3")


def test_sql_variant_runs_on_a_named_view(spark):
    logs = _logs(spark)
    a = run_query(spark, logs, "q1", "sql").collect()
    assert a == DATAFRAME_QUERIES["q1"](logs).collect()


def test_job_rejects_bad_settings_before_reading(spark):
    import pytest
    from logweave.plans.job import run_job
    with pytest.raises(ValueError):
        run_job(spark, ["/nonexistent"], "fixed", 0)
    with pytest.raises(ValueError):
        run_job(spark, ["/nonexistent"], "monthly", variant="pig")


def test_hot_path_with_a_third_of_all_rows(spark):
    """One path holds a third of the rows (spread over many hosts): exact results."""
    import collections
    d = dt.date(1995, 7, 1)
    rows = []
    for i in range(3000):
        path = "/hot" if i % 3 == 0 else f"/p{i % 97}"
        status = 404 if i % 7 == 0 else 200
        rows.append((f"h{i % 211}", "t", d, i % 24, "GET", path, "", status, i % 13))
    logs = _frame(spark, rows).repartition(8)
    want_n = collections.Counter(r[5] for r in rows)
    want_hosts = {p: len({r[0] for r in rows if r[5] == p}) for p in want_n}
    for fn in (DATAFRAME_QUERIES["q2"], TWO_STAGE_QUERIES["q2"]):
        out = fn(logs).collect()
        assert out[0].resource_path == "/hot" and out[0].request_count == 1000
        for r in out:
            assert r.request_count == want_n[r.resource_path]
            assert r.distinct_host_count == want_hosts[r.resource_path]
    errs = [r for r in rows if r[7] == 404]
    q3 = {(r.log_hour): r for r in DATAFRAME_QUERIES["q3"](logs).collect()}
    for h in range(24):
        hour_errs = [r for r in errs if r[3] == h]
        assert q3[h].error_request_count == len(hour_errs)
        assert q3[h].distinct_error_hosts == len({r[0] for r in hour_errs})
