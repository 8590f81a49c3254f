"""Access-log lines derived from the driver tables (test and bench input).

There are no real access logs here, so log lines are produced from ``events``
(and, for ISO year-boundary weeks, ``orders``) by a fixed rule.  The DuckDB
oracles compute the same columns from those tables directly, without ever
parsing a line, so a parser error shows up as a mismatch.

``events`` rule (line order = ``event_id``):

* time: ``ts + (event_id % 60) days`` (months and ISO weeks vary)
* offset: ``-0400`` / ``+0000`` / ``+0530`` by ``event_id % 3`` (never applied)
* host: ``host<user_id>.example.com``
* request: ``POST`` for purchases else ``GET``, ``/<event_type>/<k>.html``
  (``k`` from ``props``), ``HTTP/1.0``
* status: error -> 404 (even id) / 500; signup -> 302; view with id % 5 = 0
  -> 304; else 200
* bytes: ``-`` when id % 11 = 0, else ``floor(value * 100)``
* malformed with a readable date: id % 97 = 0 (closing quote left out)
* malformed without a date: id % 89 = 0 (``garbage <id>``, takes precedence)

``orders`` rule (line order = ``o_orderkey``): time ``o_orderdate +
(o_orderkey % 86400) seconds``, offset ``-0700``, host
``cust<o_custkey>.example.org``, request ``GET /priority/<o_orderpriority>
HTTP/1.1`` (``4-NOT SPECIFIED`` holds a space, so its path keeps the first
token and ``SPECIFIED`` becomes the protocol), status F -> 200, O -> 304,
P -> 503, bytes ``floor(o_totalprice)``; every 101st order spells its month in
capitals, which makes it malformed with no readable date.

Lines are written to text files with ``write_log_files``: a range partition on
the order column, so part files in name order hold the lines in order.  The table's rows
are what is partitioned and sorted; their lines are built afterwards.  The number of files
grows with the rows, so that a task sorts about ``SORT_BYTES`` at any size of the table.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import app_id, scratch_dir

#: memory that one task takes for sorting its rows, roughly
SORT_BYTES = 128 * 1024 * 1024
#: bytes of a row in a sort besides its fields: length, null bits, two pointer pairs
ROW_OVERHEAD = 48


def _stamp(t: Column, offset: Column) -> Column:
    return F.concat(F.date_format(t, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" "), offset)


def event_log_lines(events: DataFrame) -> DataFrame:
    """(event_id, line) for every event."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    t = F.timestamp_add("DAY", eid % 60, F.col("ts"))
    offset = (F.when(eid % 3 == 0, F.lit("-0400"))
              .when(eid % 3 == 1, F.lit("+0000")).otherwise(F.lit("+0530")))
    host = F.concat(F.lit("host"), F.col("user_id").cast("string"), F.lit(".example.com"))
    method = F.when(etype == "purchase", F.lit("POST")).otherwise(F.lit("GET"))
    path = F.concat(F.lit("/"), etype, F.lit("/"), F.get_json_object("props", "$.k"),
                    F.lit(".html"))
    status = (F.when(etype == "error", F.when(eid % 2 == 0, 404).otherwise(500))
              .when(etype == "signup", 302)
              .when((etype == "view") & (eid % 5 == 0), 304)
              .otherwise(200))
    size = F.when(eid % 11 == 0, F.lit("-")).otherwise(
        F.floor(F.col("value") * 100).cast("string"))
    head = F.concat(host, F.lit(" - - ["), _stamp(t, offset), F.lit('] "'),
                    method, F.lit(" "), path, F.lit(" HTTP/1.0"))
    tail = F.concat(F.lit(" "), status.cast("string"), F.lit(" "), size)
    line = (F.when(eid % 89 == 0, F.concat(F.lit("garbage "), eid.cast("string")))
            .when(eid % 97 == 0, F.concat(head, tail))
            .otherwise(F.concat(head, F.lit('"'), tail)))
    return events.select(eid.alias("event_id"), line.alias("line"))


def order_log_lines(orders: DataFrame) -> DataFrame:
    """(o_orderkey, line) for every order."""
    key = F.col("o_orderkey")
    t = F.timestamp_add("SECOND", key % 86400, F.col("o_orderdate"))
    stamp = _stamp(t, F.lit("-0700"))
    stamp = F.when(key % 101 == 0, F.upper(stamp)).otherwise(stamp)
    host = F.concat(F.lit("cust"), F.col("o_custkey").cast("string"), F.lit(".example.org"))
    status = (F.when(F.col("o_orderstatus") == "F", 200)
              .when(F.col("o_orderstatus") == "O", 304).otherwise(503))
    line = F.concat(host, F.lit(" - - ["), stamp, F.lit('] "GET /priority/'),
                    F.col("o_orderpriority"), F.lit(' HTTP/1.1" '), status.cast("string"),
                    F.lit(" "), F.floor(F.col("o_totalprice")).cast("string"))
    return orders.select(key.alias("o_orderkey"), line.alias("line"))


def _sort_bytes(rows: DataFrame) -> int:
    """Bytes of the rows in a sort: eight a field, their strings, the overhead of each row."""
    strings = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in rows.dtypes if kind in ("string", "binary")]
    row = reduce(add, strings, F.lit(8 * len(rows.columns) + ROW_OVERHEAD).cast("long"))
    return rows.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def write_log_files(rows: DataFrame, order_col: str, out_dir: str,
                    num_files: int = 4, compression: str | None = None,
                    build: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write lines as text part files whose name order is the line order.

    ``build`` makes the lines of the rows once these are in order, so that only the rows'
    own columns are shuffled and sorted; without it the rows have a ``line``.  At least
    ``num_files`` files, more when their rows would take more than ``SORT_BYTES`` each.
    """
    files = max(num_files, -(-_sort_bytes(rows) // SORT_BYTES))
    ordered = rows.repartitionByRange(files, order_col).sortWithinPartitions(order_col)
    writer = (ordered if build is None else build(ordered)).select("line").write.mode("errorifexists")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(out_dir)
    return out_dir


_FIXTURE_DIRS: dict[tuple, str] = {}


def _table(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException:
        return False


def fixture_log_dir(spark: SparkSession, sf_dir: str, table: str = "events",
                    num_files: int = 4, compression: str | None = None) -> str:
    """Folder of log files derived from ``table`` (written once per session)."""
    key = (app_id(spark), os.path.abspath(sf_dir), table,
           num_files, compression)
    if key in _FIXTURE_DIRS and not _readable(spark, _FIXTURE_DIRS[key]):
        del _FIXTURE_DIRS[key]              # the scratch folder was cleaned up
    if key not in _FIXTURE_DIRS:
        source = spark.read.parquet(_table(sf_dir, table))
        if table == "events":
            build, order = event_log_lines, "event_id"
        elif table == "orders":
            build, order = order_log_lines, "o_orderkey"
        else:
            raise ValueError(f"no log-line rule for table {table!r}")
        out = scratch_dir(spark, f"logs-{table}")
        write_log_files(source, order, out, num_files=num_files, compression=compression, build=build)
        _FIXTURE_DIRS[key] = out
    return _FIXTURE_DIRS[key]


def set_arrival_order(spark: SparkSession, log_dir: str) -> str:
    """Give the files of a folder modification times a second apart, in name order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((s.getPath() for s in fs.listStatus(path) if not s.getPath().getName().startswith(("_", "."))),
                   key=lambda p: p.getName())
    first = fs.getFileStatus(path).getModificationTime() - 1000 * len(files)
    for k, file in enumerate(files):
        fs.setTimes(file, first + 1000 * k, -1)
    return log_dir
