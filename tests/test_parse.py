"""Golden edge lines for the parser (P1-P8) and the batch-key date."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from logweave.functions.batchkeys import batch_date, month_key, week_key
from logweave.functions.parse import parse_line_column, parse_lines
from logweave.sources.text import read_log_lines
from tests.conftest import write_lines

PRE = "h - - [01/Jul/1995:00:00:01 -0400]"
SAMPLE = '199.72.81.55 - - [01/Jul/1995:00:00:01 -0400] "GET /history/apollo/ HTTP/1.0" 200 6245'

# (line, expected) - expected is None for a malformed line, else a dict of
# fields to check.
CASES = [
    (SAMPLE, dict(host="199.72.81.55", ts="01/Jul/1995:00:00:01 -0400",
                  log_date=dt.date(1995, 7, 1), log_hour=0, http_method="GET",
                  resource_path="/history/apollo/", protocol_version="HTTP/1.0",
                  status_code=200, bytes_transferred=6245)),
    (f'{PRE} "GET /a HTTP/1.0" 304 -', dict(bytes_transferred=0, status_code=304)),
    (f'{PRE} "" 400 0', dict(http_method="", resource_path="", protocol_version="")),
    (f'{PRE} "GET /a" 200 5', dict(resource_path="/a", protocol_version="")),
    (f'{PRE} "GET /a b HTTP/1.0" 200 5', dict(resource_path="/a", protocol_version="b")),
    (f'{PRE} " GET /a" 200 5', dict(http_method="", resource_path="GET", protocol_version="/a")),
    (f'{PRE} "  GET\t/a" 200 5', dict(http_method="", resource_path="GET", protocol_version="/a")),
    (f'{PRE} "GET   /a\tHTTP/1.0  " 200 5', dict(http_method="GET", resource_path="/a",
                                                  protocol_version="HTTP/1.0")),
    (f'{PRE} " " 200 5', dict(http_method="", resource_path="", protocol_version="")),
    (f'{PRE} "GET /a HTTP/1.0" 200 1.5', None),
    (f'{PRE} "GET /a HTTP/1.0" 200 +5', dict(bytes_transferred=5)),
    (f'{PRE} "GET /a HTTP/1.0" 200 -5', dict(bytes_transferred=-5)),
    (f'{PRE} "GET /a HTTP/1.0" 200 5+', None),
    (f'{PRE} "GET /a HTTP/1.0" 200 +', None),
    (f'{PRE} "GET /a HTTP/1.0" 200 9223372036854775807', dict(bytes_transferred=9223372036854775807)),
    (f'{PRE} "GET /a HTTP/1.0" 200 99999999999999999999', None),
    (f'{PRE} "GET /a HTTP/1.0" 200 5\x01', None),
    (f'{PRE} "GET /"x" HTTP/1.0" 200 5', None),
    (f'{PRE} "GET /a HTTP/1.0" 20 5', None),
    (f'{PRE} "GET /a HTTP/1.0" 2000 5', None),
    (f'{PRE} "GET /a HTTP/1.0" 200 5 ', None),
    (f'{PRE} "GET /a HTTP/1.0" 200 5\x85', None),
    (f'{PRE}\t"GET /a HTTP/1.0"\t200\t5', dict(status_code=200)),
    (f' {PRE} "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/JUL/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [31/Feb/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', dict(log_date=dt.date(1995, 2, 28))),
    ('h - - [31/Feb/1996:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', dict(log_date=dt.date(1996, 2, 29))),
    ('h - - [31/Apr/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', dict(log_date=dt.date(1995, 4, 30))),
    ('h - - [01/Jul/1995:24:00:00 -0400] "GET /a HTTP/1.0" 200 5',
     dict(log_date=dt.date(1995, 7, 2), log_hour=0, ts="01/Jul/1995:24:00:00 -0400")),
    ('h - - [31/Dec/1995:24:00:00 -0400] "GET /a HTTP/1.0" 200 5', dict(log_date=dt.date(1996, 1, 1))),
    ('h - - [01/Jul/1995:24:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:23:59:60 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:23:60:00 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:23:59:59 +0530] "GET /a HTTP/1.0" 200 5', dict(log_hour=23)),
    ('h - - [32/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [00/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [1/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/0000:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/19950:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/+01995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5', dict(log_date=dt.date(1995, 7, 1))),
    ('h - - [01/Jul/1995:00:00:01] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:00:00:01 +1800] "GET /a HTTP/1.0" 200 5', dict(log_hour=0)),
    ('h - - [01/Jul/1995:00:00:01 -1800] "GET /a HTTP/1.0" 200 5', dict(log_hour=0)),
    ('h - - [01/Jul/1995:00:00:01 +1801] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:00:00:01 +1900] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:00:00:01 +0060] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:00:00:01 0400] "GET /a HTTP/1.0" 200 5', None),
    ('h - - [01/Jul/1995:00:00:01  -0400] "GET /a HTTP/1.0" 200 5', None),
    ("garbage", None),
    ("", None),
]


def _parse(spark, lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    return {r["i"]: r for r in parse_lines(df).collect()}


def test_golden_lines(spark):
    got = _parse(spark, [c[0] for c in CASES])
    for i, (line, expected) in enumerate(CASES):
        row = got[i]
        if expected is None:
            assert row["is_malformed"], line
            assert row["host"] is None and row["log_date"] is None, line
        else:
            assert not row["is_malformed"], line
            for key, value in expected.items():
                assert row[key] == value, (line, key, row[key], value)


def test_single_column_form_agrees(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, line string")
    a = {r["i"]: r for r in parse_lines(df).collect()}
    b = {r["i"]: r["p"] for r in df.select("i", parse_line_column(F.col("line")).alias("p")).collect()}
    for i in a:
        assert a[i]["is_malformed"] == b[i]["is_malformed"]
        assert a[i]["log_date"] == b[i]["log_date"]
        assert a[i]["resource_path"] == b[i]["resource_path"]


def test_filter_on_parsed_columns_is_not_rewritten_into_the_parse(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "line string")
    parsed = parse_lines(df).filter("status_code = 200")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    # the filter sits above the Generate barrier, not on the raw line
    filter_lines = [ln for ln in plan.splitlines() if "Filter" in ln]
    assert filter_lines and all("regexp_replace" not in ln for ln in filter_lines)


BATCH_KEY_CASES = [
    ("h - - [01/Jul/1995:00:00:01 -0400] x", "1995-07", "1995-W26"),
    ("h - - [01/Jan/1995:00:00:01 -0400] x", "1995-01", "1994-W52"),
    ("h - - [31/Dec/2024:00:00:01 -0400] x", "2024-12", "2025-W01"),
    ("h - - [31/Feb/1995:xx] malformed but dated", "1995-02", "1995-W09"),
    ("h - - [01/Jul/1995] no colon", "1995-07", "1995-W26"),
    ("no brackets", "__malformed__", "__malformed__"),
    ("h ] - [01/Jul/1995:00:00:01 -0400]", "__malformed__", "__malformed__"),
    ("h - - [] empty", "__malformed__", "__malformed__"),
    ("h - - [01/JUL/1995:00:00:01 -0400]", "__malformed__", "__malformed__"),
    ("h - - [:01/Jul/1995]", "__malformed__", "__malformed__"),
    # a valid line whose host holds '[': the key's first-bracket rule finds no date
    ('a[b - - [01/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 5', "__malformed__",
     "__malformed__"),
]


def test_batch_keys(spark):
    df = spark.createDataFrame([(c[0],) for c in BATCH_KEY_CASES], "line string")
    d = batch_date(F.col("line"))
    rows = df.select("line", month_key(d).alias("m"), week_key(d).alias("w")).collect()
    for row, (line, month, week) in zip(rows, BATCH_KEY_CASES):
        assert (row["m"], row["w"]) == (month, week), line


def test_latin1_gzip_and_missing_files(spark, tmp_path):
    plain = write_lines(tmp_path / "a.log",
                        ['h - - [01/Jul/1995:00:00:01 -0400] "GET /caf\xe9 HTTP/1.0" 200 5'])
    gz_path = tmp_path / "b.log.gz"
    with gzip.open(gz_path, "wb") as fh:
        fh.write(b'g - - [02/Jul/1995:00:00:01 -0400] "GET /z HTTP/1.0" 404 -\n')
    lines = read_log_lines(spark, [plain, str(tmp_path / "missing.log"), str(gz_path)])
    rows = sorted(parse_lines(lines).collect(), key=lambda r: r["src_ordinal"])
    assert [r["resource_path"] for r in rows] == ["/café", "/z"]
    assert [r["src_ordinal"] for r in rows] == [0, 2]
    with pytest.raises(FileNotFoundError):
        read_log_lines(spark, [plain, str(tmp_path / "missing.log")], missing="fail")


def test_crlf_and_cr_line_endings(spark, tmp_path):
    good = 'h - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5'
    path = tmp_path / "crlf.log"
    path.write_bytes((good + "\r\n" + good + "\r" + good + "\n" + "\r\n").encode("latin-1"))
    rows = parse_lines(read_log_lines(spark, [str(path)])).collect()
    # Java readLine: CRLF, CR and LF all end a line; the last CRLF gives one empty line
    assert [r.is_malformed for r in sorted(rows, key=lambda r: r.src_seq)] == [False, False, False, True]


def test_long_path_lists_read_in_list_order(spark, tmp_path):
    import random
    from logweave.operators.lineindex import persisted_positions, with_line_index
    names = [f"f {i:02d}%.log" for i in range(40)]      # spaces and % in names
    for i, name in enumerate(names):
        write_lines(tmp_path / name, [f"line {i}.{j}" for j in range(3)])
    order = names[:]
    random.Random(7).shuffle(order)
    paths = [str(tmp_path / n) for n in order]
    lines = persisted_positions(read_log_lines(spark, paths))
    got = [r.line for r in with_line_index(lines).orderBy("line_index").collect()]
    assert got == [f"line {names.index(n)}.{j}" for n in order for j in range(3)]
    assert read_log_lines(spark, paths + [paths[0]]).count() == 123      # named twice, read twice


def test_many_folders_with_partition_subfolders(spark, tmp_path):
    paths = []
    for i in range(40):
        folder = tmp_path / f"site{i:02d}" / f"dt=2024-01-{i % 28 + 1:02d}"
        folder.mkdir(parents=True)
        write_lines(folder / "a.log", [f"line {i}"])
        paths.append(str(tmp_path / f"site{i:02d}"))
    got = sorted((r.src_ordinal, r.line) for r in read_log_lines(spark, paths).collect())
    assert got == [(i, f"line {i}") for i in range(40)]


def test_long_path_list_with_missing_paths(spark, tmp_path):
    import pytest
    paths = []
    for i in range(20):
        path = tmp_path / f"m{i:02d}.log"
        if i % 5 != 0:
            write_lines(path, [f"line {i}"])
        paths.append(str(path))                       # every 5th path is missing
    lines = read_log_lines(spark, paths)
    got = sorted((r.src_ordinal, r.line) for r in lines.collect())
    assert got == [(i, f"line {i}") for i in range(20) if i % 5 != 0]
    with pytest.raises(FileNotFoundError):
        read_log_lines(spark, paths, missing="fail")
