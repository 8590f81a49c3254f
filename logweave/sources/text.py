"""Raw access-log sources.

``read_log_lines`` reads an ordered list of text logs (plain or ``.gz``) with
``spark.read.text`` and decodes each line as ISO-8859-1.  Every line carries the
columns that fix its position in the input without a global sort:

* ``src_ordinal``  position of its path in the given list,
* ``src_file``     the file it came from (``input_file_name()``; a directory
  path expands to its files, taken in name order),
* ``src_block``    start offset of the file split it was read from,
* ``src_seq``      ``monotonically_increasing_id()``: consecutive inside one
  split because a split is never divided between tasks.

Ordering by ``(src_ordinal, src_file, src_block, src_seq)`` is the line order of
the input; ``operators.lineindex`` turns it into a 0-based global index with one
small aggregate instead of a one-partition window.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_COLUMNS = ["src_ordinal", "src_file", "src_block", "src_seq"]
SEGMENT_COLUMNS = ["src_ordinal", "src_file", "src_block"]
LINE_ENCODING = "ISO-8859-1"


def decode_latin1(value_col: str = "value"):
    """Spark's text reader keeps raw bytes; decode them as ISO-8859-1."""
    return F.decode(F.col(value_col).cast("binary"), LINE_ENCODING)


#: files of a listing up to which it is broadcast (a path and a number each)
LISTING_BROADCAST = 100_000
LIST_THREADS = 16
LINE_SCHEMA = "line string, src_ordinal int, src_file string, src_block long, src_seq long"


def read_log_lines(spark: SparkSession, paths: str | Sequence[str],
                   missing: str = "skip") -> DataFrame:
    """Lines of the given logs, in input order, with position columns.

    ``missing='skip'`` leaves out paths that do not exist (the batch iterators'
    behaviour); ``missing='fail'`` raises ``FileNotFoundError`` (the CLI's).

    All paths are one scan, whatever the length of the list: their files are listed
    as (file, ordinal), and the lines of the scan get their ordinals by a join with that
    listing.  A folder may have its own partition sub-folders; a file that is named
    twice is read once and its lines come twice.
    """
    if isinstance(paths, str):
        paths = [paths]
    if missing not in ("skip", "fail"):
        raise ValueError("missing must be 'skip' or 'fail'")
    listing = []
    for ordinal, (path, files) in enumerate(zip(paths, _list_files(spark, list(paths)))):
        if files is None:
            if missing == "fail":
                raise FileNotFoundError(path)
            continue
        listing += [(name, url, ordinal) for name, url in files]
    if not listing:
        return spark.createDataFrame([], LINE_SCHEMA)
    # a file is scanned once, however its URL is spelled
    distinct = list({re.sub("^([A-Za-z0-9+.-]+):/+", r"\1:/", url): name for name, url, _ in listing}.values())
    scan = spark.read.text([_literal(name) for name in distinct]).select(
        decode_latin1().alias("line"), F.input_file_name().alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_seq"),
        _file_key(F.col("_metadata.file_path")).alias("_file"))
    ordinals = {ordinal for _, _, ordinal in listing}
    if len(ordinals) == 1 and len(distinct) == len(listing):
        numbered = scan.withColumn("src_ordinal", F.lit(ordinals.pop()).cast("int"))
    else:
        known = spark.createDataFrame([(url, ordinal) for _, url, ordinal in listing], "url string, src_ordinal int"
                                      ).select(_file_key(F.col("url")).alias("_file"), "src_ordinal")
        numbered = scan.join(F.broadcast(known) if len(listing) <= LISTING_BROADCAST else known, "_file")
    return numbered.select("line", "src_ordinal", "src_file", "src_block", "src_seq")


def _file_key(url: Column) -> Column:
    """A file's URL in one spelling (``file:/a`` and ``file:///a`` are one file)."""
    return F.regexp_replace(url, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _literal(file: str) -> str:
    """A file name that the reader does not take for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", file)


def _list_files(spark: SparkSession, paths: list[str]) -> list[list[tuple[str, str]] | None]:
    """(name, URL) of the log files of each path (a file, folder or pattern); None: no such path.

    Folders are listed by the reader, with their sub-folders and without hidden files.  A long
    list is resolved by a few driver threads: on an object store each listing is a round trip.
    """
    jvm = spark.sparkContext._jvm
    configuration = spark.sparkContext._jsc.hadoopConfiguration()

    def files_of(status) -> list[tuple[str, str]]:
        place = status.getPath()
        if not status.isDirectory():
            return [(place.toString(), place.toUri().toString())]
        return [(unquote(url), url) for url in spark.read.text(_literal(place.toString())).inputFiles()]

    def one(path: str) -> list[tuple[str, str]] | None:
        place = jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(configuration)
        # a name that is there is no pattern, whatever signs it has
        found = [fs.getFileStatus(place)] if fs.exists(place) else fs.globStatus(place)
        if not found:
            return None
        return [file for status in found for file in files_of(status)]

    with ThreadPoolExecutor(max_workers=LIST_THREADS) as pool:
        return list(pool.map(one, paths))


# Hadoop codecs whose files cannot be split: one task reads the whole file.
UNSPLITTABLE_SUFFIXES = (".gz", ".deflate", ".zst", ".lz4", ".snappy")


#: text that a byte of a compressed log becomes, roughly
INFLATION = 10


def rebalance_lines(lines: DataFrame) -> DataFrame:
    """Spread lines over the cluster when large unsplittable files are read.

    A ``.gz`` file is one task, however large it is.  When the text of any
    unsplittable file is likely larger than a split (``INFLATION`` times its size
    against ``spark.sql.files.maxPartitionBytes``), the lines are round-robin
    repartitioned to about one split each - after the position columns were taken at
    the scan, so input order is unaffected.  Plain text is split by size already.
    """
    spark = lines.sparkSession
    packed = sorted({f for f in lines.inputFiles() if f.endswith(UNSPLITTABLE_SUFFIXES)})
    if not packed:
        return lines
    largest, total = (spark.read.format("binaryFile").load(packed)
                      .agg(F.max("length"), F.sum("length")).first())
    split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if largest * INFLATION <= split:
        return lines
    return lines.repartition(max(2, -(-total * INFLATION // split)))


def _bytes(setting: str) -> int:
    """A size setting such as 134217728, 128m or 128MB in bytes."""
    number = setting.lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(number[:-1]) << units[number[-1]] if number[-1] in units else int(number)
