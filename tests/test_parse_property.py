"""Property test: the Spark parser against a brute-force model of the reference rules.

Lines are generated from a grammar that mixes valid pieces with edge tokens; the
model is plain Python (``re`` in ASCII mode has Java's ``\\s`` and ``\\d``, and
``fullmatch`` is Java's ``matches``), dates via ``calendar``.
"""

import calendar
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logweave.constants import LOG_LINE_REGEX, MONTH_NAMES
from logweave.functions.parse import parse_lines

LINE = re.compile(LOG_LINE_REGEX.replace(r"\z", ""), re.ASCII)
STAMP = re.compile(r"(\d{2})/([A-Za-z]{3})/(\d{4}|\+\d{5,19}):(\d{2}):(\d{2}):(\d{2}) "
                   r"([+-])(\d{2})(\d{2})", re.ASCII)
WS = re.compile(r"\s+", re.ASCII)


def model(line):
    m = LINE.fullmatch(line)
    if not m:
        return None
    host, ts, request, status, size = m.groups()
    t = STAMP.fullmatch(ts)
    if not t or t.group(2) not in MONTH_NAMES:
        return None
    day, mon, year, hh, mi, ss, _, oh, om = t.groups()
    day, year, hh, mi, ss, oh, om = map(int, (day, year.lstrip("+"), hh, mi, ss, oh, om))
    month = MONTH_NAMES.index(mon) + 1
    end_of_day = hh == 24 and mi == 0 and ss == 0
    if not (1 <= day <= 31 and 1 <= year <= 9999 and mi <= 59 and ss <= 59
            and (hh <= 23 or end_of_day) and om <= 59 and oh * 60 + om <= 18 * 60):
        return None
    date = dt.date(year, month, min(day, calendar.monthrange(year, month)[1]))
    if end_of_day:
        date += dt.timedelta(days=1)
    if size == "-":
        nbytes = 0
    elif re.fullmatch(r"[+-]?[0-9]+", size, re.ASCII) and -2**63 <= int(size) < 2**63:
        nbytes = int(size)
    else:
        return None
    parts = WS.split(request)
    while parts and parts[-1] == "":          # Java drops trailing empty strings
        parts.pop()
    parts += ["", "", ""]
    return (host, ts, date, 0 if end_of_day else hh, parts[0], parts[1], parts[2],
            int(status), nbytes)


def mostly(good, edge, weight=8):
    """Sample ``good`` values most of the time and ``edge`` values now and then."""
    return st.sampled_from(list(good) * weight + list(edge))


SPACE = mostly([" "], ["  ", "\t", " \t "])
TOKEN = mostly(["h", "a.b.c", "-"], ["x[y", "x]y", 'q"r', "\\z", "é", "\x85", "h\x01"], 3)
DAY = mostly(["01", "15", "28"], ["29", "30", "31", "00", "32", "1", "07"], 10)
MON = mostly(MONTH_NAMES, ["JUL", "jul", "Foo"], 3)
YEAR = mostly(["1995", "1996", "2000"], ["2100", "0000", "+01995", "+1995", "19950", "9999"], 10)
CLOCK = mostly(["00:00:01", "23:59:59", "07:08:09"],
               ["24:00:00", "24:00:01", "23:59:60", "12:60:00"], 10)
OFFSET = mostly(["-0400", "+0000"], ["-0000", "+1800", "-1800", "+1801", "+1900", "+0060",
                                     "0400", "+05", ""], 20)
REQUEST = mostly(["GET /a HTTP/1.0", "GET /b/c.html HTTP/1.1"],
                 ["", " ", " GET /a", "GET", "GET /a b c", "GET\t/x  HTTP/1.1 ",
                  "POST /é?q=1 HTTP/1.0", "GET /a]b", "a\x0bb\x0cc"], 4)
STATUS = mostly(["200", "404", "599"], ["20", "2000", "abc"], 12)
BYTES = mostly(["-", "0", "6245"], ["+5", "-5", "1.5", "5+", "+", "9223372036854775807",
                                    "9223372036854775808", "5\x01", "٣"], 12)


@st.composite
def log_line(draw):
    stamp = f"{draw(DAY)}/{draw(MON)}/{draw(YEAR)}:{draw(CLOCK)} {draw(OFFSET)}"
    if draw(st.integers(0, 29)) == 0:
        stamp = stamp.rstrip()
    parts = [draw(TOKEN), draw(SPACE), draw(TOKEN), draw(SPACE), draw(TOKEN), draw(SPACE),
             "[" + stamp + "]", draw(SPACE), '"' + draw(REQUEST) + '"', draw(SPACE),
             draw(STATUS), draw(SPACE), draw(BYTES)]
    if draw(st.integers(0, 49)) == 0:
        parts.append(draw(st.sampled_from([" ", "x", '"'])))
    return "".join(parts)


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(log_line(), min_size=50, max_size=80))
def test_parser_matches_brute_force_model(spark, lines):
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "i int, line string")
    got = {r["i"]: r for r in parse_lines(df).collect()}
    for i, line in enumerate(lines):
        want = model(line)
        row = got[i]
        if want is None:
            assert row["is_malformed"], repr(line)
        else:
            assert not row["is_malformed"], repr(line)
            have = (row["host"], row["ts"], row["log_date"], row["log_hour"], row["http_method"],
                    row["resource_path"], row["protocol_version"], row["status_code"],
                    row["bytes_transferred"])
            assert have == want, (repr(line), have, want)


DATE_PART = re.compile(r"(\d{2})/([A-Za-z]{3})/(\d{4}|\+\d{5,19})", re.ASCII)


def batch_date_model(line):
    """First '[' to first ']', text before the first ':', SMART dd/MMM/yyyy."""
    open_at, close_at = line.find("["), line.find("]")
    if open_at < 0 or close_at < 0 or close_at <= open_at:
        return None
    inner = line[open_at + 1:close_at]
    m = DATE_PART.fullmatch(inner.split(":")[0] if inner else "")
    if not m or m.group(2) not in MONTH_NAMES:
        return None
    day, year = int(m.group(1)), int(m.group(3).lstrip("+"))
    if not (1 <= day <= 31 and 1 <= year <= 9999):
        return None
    month = MONTH_NAMES.index(m.group(2)) + 1
    return dt.date(year, month, min(day, calendar.monthrange(year, month)[1]))


@st.composite
def keyed_line(draw):
    line = draw(log_line())
    if draw(st.integers(0, 3)) == 0:                 # stray brackets / colons
        pos = draw(st.integers(0, len(line)))
        line = line[:pos] + draw(st.sampled_from(["[", "]", ":", "[:", "]["])) + line[pos:]
    return line


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(keyed_line(), min_size=50, max_size=80))
def test_batch_date_matches_brute_force_model(spark, lines):
    from pyspark.sql import functions as F
    from logweave.functions.batchkeys import batch_date
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "i int, line string")
    got = {r["i"]: r["d"] for r in df.select("i", batch_date(F.col("line")).alias("d")).collect()}
    for i, line in enumerate(lines):
        assert got[i] == batch_date_model(line), repr(line)
