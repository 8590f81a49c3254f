"""Batching (B1-B9) and the global line index (7.3)."""

import os

from pyspark.sql import functions as F

from logweave.functions.parse import parse_lines
from logweave.operators.batching import batch_stats, run_stats
from logweave.operators.lineindex import persisted_positions, with_line_index
from logweave.plans.job import parse_for_staging
from logweave.sources.fixtures import fixture_log_dir
from logweave.sources.text import read_log_lines
from tests.conftest import SF_SMALL, write_lines


def _file_lines(folder):
    """All lines of the part files in name order (the reference's reading order)."""
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith(("_", ".")):
            continue
        with open(os.path.join(folder, name), "rb") as fh:
            out.extend(fh.read().decode("latin-1").splitlines())
    return out


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_line_index_is_input_order_across_files_and_splits(spark):
    folder = fixture_log_dir(spark, SF_SMALL)
    expected = _file_lines(_local(folder))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")   # many splits per file
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        lines = read_log_lines(spark, [folder])
        assert lines.select("src_file", "src_block").distinct().count() > 8
        indexed = with_line_index(persisted_positions(lines), broadcast_max_bytes=-1)   # shuffle join
        got = [r["line"] for r in indexed.orderBy("line_index").select("line").collect()]
        idx = [r["line_index"] for r in indexed.select("line_index").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == expected
    assert sorted(idx) == list(range(len(expected)))


def test_fixed_batches_span_files(spark, tmp_path):
    a = write_lines(tmp_path / "a.log", [f"x{i}" for i in range(7)])
    b = write_lines(tmp_path / "b.log", [
        'h - - [01/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 1' for _ in range(6)])
    staged = parse_for_staging(read_log_lines(spark, [a, b]))
    rows = batch_stats(staged, "fixed", 5).orderBy("batch_sequence").collect()
    assert [(r.batch_key, r.total_records, r.valid_records, r.malformed_records) for r in rows] == [
        ("batch_1", 5, 0, 5), ("batch_2", 5, 3, 2), ("batch_3", 3, 3, 0)]
    totals = run_stats(batch_stats(staged, "fixed", 5), "fixed", 5).first()
    assert (totals.total_records, totals.malformed_records, totals.num_batches) == (13, 7, 3)
    assert abs(totals.avg_batch_size - 13 / 3) < 1e-12


def test_calendar_batches_in_first_appearance_order(spark, tmp_path):
    lines = [
        'h - - [01/Aug/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 1',
        "garbage",
        'h - - [31/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0 200 1',     # malformed, dated
        'h - - [01/Jan/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 1',
        'h - - [02/Aug/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 1',
    ]
    staged = parse_for_staging(read_log_lines(spark, [write_lines(tmp_path / "m.log", lines)]))
    monthly = [(r.batch_sequence, r.batch_key, r.total_records, r.malformed_records)
               for r in batch_stats(staged, "month").orderBy("batch_sequence").collect()]
    assert monthly == [(1, "1995-08", 2, 0), (2, "__malformed__", 1, 1),
                       (3, "1995-07", 1, 1), (4, "1995-01", 1, 0)]
    weekly = [r.batch_key for r in batch_stats(staged, "week").orderBy("batch_sequence").collect()]
    # 31 Jul 1995 is a Monday: same ISO week as 1 Aug
    assert weekly == ["1995-W31", "__malformed__", "1994-W52"]


def test_empty_input_run_stats(spark, tmp_path):
    staged = parse_for_staging(read_log_lines(spark, [write_lines(tmp_path / "e.log", [])]))
    totals = run_stats(batch_stats(staged, "monthly"), "monthly", 10000).first()
    assert (totals.total_records, totals.num_batches, totals.avg_batch_size) == (0, 0, 0.0)


def test_strategy_names():
    from logweave.functions.batchkeys import normalise_strategy
    assert [normalise_strategy(s) for s in ["MONTH", "monthly", "Week", "weekly", "x", None]] == [
        "monthly", "monthly", "weekly", "weekly", "fixed", "fixed"]


def test_results_do_not_depend_on_partitioning(spark):
    """Batches and queries are the same under other shuffle widths and split sizes."""
    from logweave.operators.queries import DATAFRAME_QUERIES
    from logweave.functions.parse import valid_rows

    def snapshot():
        staged = parse_for_staging(read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)]))
        out = {s: sorted(map(tuple, batch_stats(staged, s, 37).collect()))
               for s in ("fixed", "monthly", "weekly")}
        logs = valid_rows(parse_lines(read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])))
        out.update({q: fn(logs).collect() for q, fn in DATAFRAME_QUERIES.items()})
        return out

    base = snapshot()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        other = snapshot()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert other == base


def test_gzip_job_is_rebalanced_and_keeps_order(spark, tmp_path):
    import gzip
    from logweave.plans.job import run_job
    from logweave.sources.text import rebalance_lines
    folder = _local(fixture_log_dir(spark, SF_SMALL))
    expected = _file_lines(folder)
    gz = tmp_path / "all.log.gz"
    with gzip.open(gz, "wb") as fh:
        fh.write(("\n".join(expected) + "\n").encode("latin-1"))
    lines = read_log_lines(spark, [str(gz)])
    assert lines.rdd.getNumPartitions() == 1
    assert rebalance_lines(lines) is lines                   # its text fits in one split
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert rebalance_lines(lines).rdd.getNumPartitions() == -(-10 * gz.stat().st_size // 16384)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    job = run_job(spark, [str(gz)], "fixed", 97)
    got = [(r.batch_sequence, r.total_records, r.malformed_records)
           for r in job.batches.orderBy("batch_sequence").collect()]
    staged = parse_for_staging(read_log_lines(spark, [folder]))
    want = [(r.batch_sequence, r.total_records, r.malformed_records)
            for r in batch_stats(staged, "fixed", 97).orderBy("batch_sequence").collect()]
    assert got == want and len(got) == 11


def test_plain_text_is_not_rebalanced(spark):
    from logweave.sources.text import rebalance_lines
    lines = read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])
    assert rebalance_lines(lines) is lines


def test_line_index_broadcast_paths_agree(spark):
    folder = fixture_log_dir(spark, SF_SMALL)
    lines = read_log_lines(spark, [folder])
    stored = persisted_positions(lines)
    variants = [with_line_index(stored), with_line_index(stored, broadcast_max_bytes=-1)]
    results = [sorted((r.line_index, r.line) for r in v.select("line_index", "line").collect())
               for v in variants]
    assert results[0] == results[1]
    plan = variants[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_changed_splits_between_scans_lose_no_line(spark):
    """The index reads stored positions: other splits at the second scan change nothing,
    and rows of unknown segments raise instead of vanishing."""
    import pytest
    lines = read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])
    indexed = with_line_index(persisted_positions(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        assert sorted(r[0] for r in indexed.select("line_index").collect()) == list(range(1000))
        other = read_log_lines(spark, [fixture_log_dir(spark, SF_SMALL)])
        for most in (1 << 20, -1):
            half = persisted_positions(lines).filter("src_seq % 7 = 0")
            strange = half.withColumn("src_block", F.col("src_block") + 1)
            from logweave.operators import lineindex
            offsets = lineindex.segment_offsets(half)
            real = lineindex.segment_offsets
            lineindex.segment_offsets = lambda *a, **k: offsets
            try:
                with pytest.raises(Exception, match="was not counted"):
                    with_line_index(strange, broadcast_max_bytes=most).collect()
            finally:
                lineindex.segment_offsets = real
        assert batch_stats(parse_for_staging(other), "fixed", 100).count() == 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_segments_are_many_join_keys(spark):
    rows = spark.range(0, 5_000_000, 1, 3).select(
        F.lit(0).alias("src_ordinal"), F.lit("a.gz").alias("src_file"),
        F.lit(0).cast("long").alias("src_block"), (F.col("id") + 10).alias("src_seq"))
    out = with_line_index(rows, broadcast_max_bytes=-1).agg(
        F.count("line_index"), F.min("line_index"), F.max("line_index")).first()
    assert tuple(out) == (5_000_000, 0, 4_999_999)
