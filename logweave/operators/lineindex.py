"""Global 0-based line index without a one-partition window over lines or splits.

Lines carry segment columns (one segment = one file split) and a sequence number
that is consecutive inside a segment (see ``sources.text``).  The index is
``offset(segment) + seq - first_seq(segment)``; the offsets are a prefix sum over the
per-segment line counts.

The positions are taken from *persisted* rows: a second scan of raw logs may be split
otherwise (splits depend on the parallelism of the moment), so ``persisted_positions``
writes the narrow position columns first, unless the caller's rows are stored already.
A line whose segment has no offset raises instead of being dropped.

Prefix sum, in two steps: splits are summed inside their file, distributed by file; only the
files' totals - one row per file, as the driver's listing has - go through an un-partitioned
window.  The offsets are stored once; nothing else is written.

Join back: the offsets are broadcast if their stored size, times ``INFLATION``, is at most
``BROADCAST_MAX_BYTES``; the size is the store's, so it costs no job.  Otherwise lines and
offsets are shuffled by (segment, stretch of ``STRETCH`` sequence numbers), so that a segment
of any length - a gzip file is one - is many keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.session import scratch_dir
from logweave.sources.text import SEGMENT_COLUMNS

BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: bytes in a broadcast hash table for a byte of the stored offsets (columns coded, paths by dictionary)
INFLATION = 24
STRETCH = 1 << 20


def _stored(frame: DataFrame, name: str) -> DataFrame:
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def persisted_positions(lines: DataFrame) -> DataFrame:
    """The given columns written to the shared folder and read back."""
    return _stored(lines, "positions")


def segment_offsets(lines: DataFrame, segment_cols: Sequence[str] = SEGMENT_COLUMNS,
                    seq_col: str = "src_seq") -> DataFrame:
    """One row per segment: line count, first sequence number, global offset (stored)."""
    *file_cols, split_col = segment_cols
    stats = lines.groupBy(*segment_cols).agg(F.count(F.lit(1)).alias("seg_lines"),
                                             F.min(seq_col).alias("seg_first"))

    def before(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    if not file_cols:                            # the splits are the files
        offset = F.coalesce(F.sum("seg_lines").over(before(Window.orderBy(split_col))), F.lit(0))
        return _stored(stats.withColumn("seg_offset", offset.cast("long")), "offsets")
    in_file = before(Window.partitionBy(*file_cols).orderBy(split_col))
    files = stats.groupBy(*file_cols).agg(F.sum("seg_lines").alias("file_lines"))
    file_offset = F.coalesce(F.sum("file_lines").over(before(Window.orderBy(*file_cols))), F.lit(0))
    within = F.coalesce(F.sum("seg_lines").over(in_file), F.lit(0))
    return _stored(stats.withColumn("seg_within", within).join(
        files.select(*file_cols, file_offset.alias("file_offset")), file_cols).select(
        *segment_cols, "seg_lines", "seg_first",
        (F.col("file_offset") + F.col("seg_within")).cast("long").alias("seg_offset")), "offsets")


def _stored_bytes(frame: DataFrame) -> int:
    """Size of the files that a stored frame reads."""
    spark, total = frame.sparkSession, 0
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(folder))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += fs.getContentSummary(path).getLength()
    return total


def with_line_index(lines: DataFrame, segment_cols: Sequence[str] = SEGMENT_COLUMNS,
                    seq_col: str = "src_seq", index_col: str = "line_index",
                    broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``lines`` (persisted rows) plus a 0-based index in input order."""
    segment_cols = list(segment_cols)
    offsets = segment_offsets(lines, segment_cols, seq_col)
    if _stored_bytes(offsets) * INFLATION <= broadcast_max_bytes:
        joined = lines.join(F.broadcast(offsets.select(*segment_cols, "seg_first", "seg_offset")),
                            segment_cols, "left")
    else:
        stretch = F.expr(f"{seq_col} div {STRETCH}")
        side = offsets.select(*segment_cols, "seg_first", "seg_offset", F.explode(F.expr(
            f"sequence(seg_first div {STRETCH}, (seg_first + seg_lines - 1) div {STRETCH})"))
            .alias("seg_stretch"))
        joined = lines.withColumn("seg_stretch", stretch).join(
            side, [*segment_cols, "seg_stretch"], "left").drop("seg_stretch")
    lost = F.raise_error(F.lit("line index: a line of a segment that was not counted")).cast("long")
    return joined.withColumn(
        index_col, F.coalesce(F.col("seg_offset") + F.col(seq_col) - F.col("seg_first"), lost)
    ).drop("seg_first", "seg_offset")
