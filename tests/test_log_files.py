"""Log files written from tables: a task's sort does not grow with the table."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from logweave.session import scratch_dir
from logweave.sources import fixtures
from logweave.sources.fixtures import event_log_lines, fixture_log_dir, write_log_files

ROWS = 2000


@pytest.fixture(scope="module")
def sf_dir(spark):
    """An events table of rows in no order; every tenth has null fields."""
    day = dt.datetime(2024, 1, 1)
    rows = [(k, day + dt.timedelta(minutes=k), k % 50, ("view", "error", "purchase")[k % 3], k / 7,
             f'{{"k": {k % 30}}}') if k % 10 else (k, None, None, None, None, None) for k in range(ROWS)]
    folder = scratch_dir(spark, "events-table")
    spark.createDataFrame(rows[::-1], "event_id long, ts timestamp, user_id long, event_type string, value double, "
                                      "props string").repartition(3).write.parquet(f"{folder}/events.parquet")
    return folder


def _files(folder):
    """Lines of each part file, in name order."""
    return [open(f, encoding="utf-8").read().split("\n")[:-1]
            for f in sorted(glob.glob(folder.replace("file:", "") + "/part-*"))]


def _lines(spark, sf_dir):
    lines = event_log_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return [r.line or "" for r in lines.orderBy("event_id").collect()]


def test_more_rows_are_more_files_not_larger_sorts(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "SORT_BYTES", 16 * 1024, raising=False)
    lines = event_log_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))
    for k, (rows, build) in enumerate(((lines, None), (spark.read.parquet(f"{sf_dir}/events.parquet"), event_log_lines))):
        written = _files(write_log_files(rows, "event_id", str(tmp_path / f"logs-{k}"),
                                         **({"build": build} if build else {})))
        assert len(written) > 8 and max(map(len, written)) <= 16 * 1024 // 40
        assert [x for file in written for x in file] == _lines(spark, sf_dir)


def test_small_tables_keep_their_files(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    written = _files(write_log_files(event_log_lines(rows), "event_id", str(tmp_path / "few")))
    assert len(written) == 4 and sum(map(len, written)) == ROWS
    none = write_log_files(event_log_lines(rows.limit(0)), "event_id", str(tmp_path / "none"))
    assert sum(map(len, _files(none))) == 0


def test_fixture_folder_grows_in_files(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "SORT_BYTES", 16 * 1024, raising=False)
    written = _files(fixture_log_dir(spark, sf_dir))
    assert len(written) > 8
    assert [x for file in written for x in file] == _lines(spark, sf_dir)


def test_report_of_long_paths_sorts_no_long_lines(spark, sf_dir, monkeypatch):
    """report_q2_long_paths: what is shuffled and sorted are events, 600 characters shorter."""
    sorted_columns = []
    plain = entry.write_log_files

    def seen(rows, *args, **kwargs):
        sorted_columns.append(rows.columns)
        return plain(rows, *args, **kwargs)
    monkeypatch.setattr(entry, "write_log_files", seen)
    monkeypatch.setattr(fixtures, "SORT_BYTES", 16 * 1024, raising=False)
    report = entry.q_report_q2_long_paths(spark, sf_dir).collect()
    assert sorted_columns and all("line" not in columns for columns in sorted_columns)
    assert len(report) == 20 and {len(r.resource_path) for r in report} == {47}


def test_cut_paths_are_the_same_from_any_number_of_files(spark, sf_dir, monkeypatch):
    """jdbc_paths_cut: the rows do not depend on how many files hold the log."""
    few = entry.q_jdbc_paths_cut(spark, sf_dir).collect()
    folders = []
    plain = entry.write_log_files
    monkeypatch.setattr(entry, "write_log_files", lambda *a, **b: folders.append(plain(*a, **b)) or folders[-1])
    monkeypatch.setattr(fixtures, "SORT_BYTES", 16 * 1024, raising=False)
    many = entry.q_jdbc_paths_cut(spark, sf_dir).collect()
    written = _files(folders[0])
    assert len(written) > 8 and many == few and {len(r.resource_path) for r in many} == {512}
    lines = event_log_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))
    expected = [r.line or "" for r in lines.withColumn("line", entry._long_path_lines(F.col("line")))
                .orderBy("event_id").collect()]
    assert [x for file in written for x in file] == expected
